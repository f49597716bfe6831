"""Every registered query against its SQL, on the given tables and on skewed copies of them."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from tests.compare import differences, duck

SMALL = "/root/testdata/sf0.001"
QUERIES, SQL = entry.catalog.queries(), entry.oracles.oracle_sql()


@pytest.fixture(scope="module")
def small():
    return duck(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, small, name):
    assert differences(QUERIES[name](spark, SMALL), small, SQL[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry.entry(spark).count() == 200


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """A third of all pages in one document, of all turns in one conversation, of all events with one user."""
    root = tmp_path_factory.mktemp("skewed")

    def copy(name, change):
        table = change(pq.read_table(f"{SMALL}/{name}.parquet"))
        pq.write_table(table, root / f"{name}.parquet")

    def longest(docs):
        rows = docs.to_pylist()
        lines = [line for r in rows for line in r["text"].split("\n")]
        rows[5]["text"] = "\n".join((lines * 10)[: max(9000, len(lines) // 2)])
        rows[5]["n_chars"] = len(rows[5]["text"])
        return pa.Table.from_pylist(rows, docs.schema)

    def chatty(turns):
        rows = turns.to_pylist()
        many = [{**r, "conv_id": 0, "turn": n + 100} for n, r in enumerate(rows[: len(rows) // 2])]
        return pa.Table.from_pylist(rows + many, turns.schema)

    def busy(events):
        rows = events.to_pylist()
        for n, r in enumerate(rows):
            if n % 3 == 0:
                r["user_id"] = 1
        return pa.Table.from_pylist(rows, events.schema)

    copy("documents", longest)
    copy("conversations", chatty)
    copy("events", busy)
    for name in ("labels", "embeddings", "part"):
        copy(name, lambda table: table)
    return str(root)


@pytest.mark.parametrize(
    "name",
    [
        "assemble_text", "assemble_chat", "document_index", "document_json", "docs_roundtrip", "sink_txt",
        "image_results", "cascade_delete", "append_results", "conf_percent", "tokens_space", "page_metrics",
        "doc_time", "document_feed", "run_rounds",
    ],
)
def test_skewed_query_equals_sql(spark, skewed, name):
    assert differences(QUERIES[name](spark, skewed), duck(skewed), SQL[name]) == []
