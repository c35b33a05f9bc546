import random
import re

from chunksink.llm.quality_rules import apply_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n)


def texts():
    r = random.Random(2)
    words = ["the", "of", "a#", "zebra", "ünï", "|", "and", "🙂x", "de"]
    out = []
    for _ in range(120):
        line = [r.choice(words) for _ in range(r.randint(1, 12))]
        lines = []
        for _ in range(r.randint(1, 8)):
            if r.random() < 0.5:
                line = [r.choice(words) for _ in range(r.randint(0, 12))]
            lines.append(r.choice([" ", "  ", "\t", "\x0b"]).join(line))
        out.append("\n".join(lines))
    return [*out, None, "", " \n\t", "one", "the of and " * 20_000, "a b c d e f g h " * 2 + "x"]


def test_measures_match_brute_force(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "old") for i, t in rows], "doc_id long, text string, kept string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in apply_rules(df).collect()}
    assert got == {i: base(t) for i, t in rows}


def test_verdict(spark):
    clean = "The story of the town and of the people in it is long, and this is only a part of what was told to me."
    rows = [(1, clean), (2, clean.upper().replace(" ", "!! ")), (3, clean.replace(" ", " | ")), (4, clean.replace(" ", "%%% ")), (5, "zxq vbn mkl " + "qwr tyu iop asd fgh jkl zxc vbn nmq wer rty uio pas dfg ghj klz xcv" + " x"), (1, clean)]
    got = [(r.doc_id, r.kept) for r in apply_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == [(1, True), (1, True), (2, False), (3, False), (4, False), (5, False)]
    plan = apply_rules(spark.createDataFrame(rows, "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_empty_table(spark):
    assert apply_rules(spark.createDataFrame([], "doc_id long, text string")).count() == 0
