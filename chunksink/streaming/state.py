"""What has been persisted: the height and hash of the last batch."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Protocol

from chunksink.sources.dest import Dest


@dataclass(frozen=True)
class Head:
    height: int = -1
    hash: str = "0x"


class StateHooks(Protocol):
    def on_state_read(self, dest: Dest) -> Head | None: ...

    def on_state_update(self, dest: Dest, state: Head, previous: Head) -> None: ...


@dataclass(frozen=True)
class TextState:
    """``height``, a line break, ``hash``; a missing hash reads as ``0x``."""

    file: str = "status.txt"

    def on_state_read(self, dest: Dest) -> Head | None:
        if not dest.exists(self.file):
            return None
        height, _, rest = dest.read_file(self.file).partition("\n")
        return Head(int(height), rest.split("\n")[0] or "0x")

    def on_state_update(self, dest: Dest, state: Head, previous: Head) -> None:
        dest.write_file(self.file, f"{state.height}\n{state.hash}")


@dataclass(frozen=True)
class JsonState:
    """The state as a JSON document, with the one before it."""

    file: str = "status.json"

    def on_state_read(self, dest: Dest) -> Head | None:
        if not dest.exists(self.file):
            return None
        found = json.loads(dest.read_file(self.file))
        return Head(found["height"], found.get("hash", "0x"))

    def on_state_update(self, dest: Dest, state: Head, previous: Head) -> None:
        dest.write_file(self.file, json.dumps({"height": state.height, "hash": state.hash, "previous": {"height": previous.height, "hash": previous.hash}}))
