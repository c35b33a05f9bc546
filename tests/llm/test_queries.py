import os

import pytest

from chunksink.llm import queries
from tests.oracle import SF_DIR, compare

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")

COLUMNS = {
    "op1": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op4": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op5": ["doc_id", "held_out", "score", "predicted"],
    "op6": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op7": ["page_id", "url", "text", "n_chars"],
    "op8": ["doc_id", "fingerprint", "component_id"],
    "op9": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op10": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    compare(spark, queries.QUERIES[name], queries.ORACLES[name])


def test_contract_columns_and_rows(spark):
    assert sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES) == list(range(1, 11))
    for name, query in queries.QUERIES.items():
        want = COLUMNS.get(name.split("_")[0])
        df = query(spark, SF_DIR)
        if want:
            assert df.columns[: len(want)] == want
            table = "pages" if name.startswith("op7") else "documents"
            assert df.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


def test_passages_on_the_test_tables(spark):
    """Whole query against brute force with its production window."""
    from tests.llm.test_repeats import bytes_by_hand, words_by_hand

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in queries.op1_substring_dedup(spark, SF_DIR).collect())
    assert got == words_by_hand(rows, 50)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op10_suffix_array(spark, SF_DIR).collect())
    assert got == bytes_by_hand(rows, 400)


def test_components_on_the_test_tables(spark):
    from tests.llm.test_simhash import by_hand

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = sorted((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in queries.op8_simhash(spark, SF_DIR).collect())
    assert got == by_hand(rows)
