"""Queries that SQL expresses, on given tables and on odd rows."""

from __future__ import annotations

import duckdb
import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry_points
from llm_fixtures import SMALL, collected, frame  # noqa: F401

from salesmart.llm import chat, oracle, queries, urls

SQL = oracle.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SMALL), queries.queries()[name], SQL[name], SMALL) is None


def test_all_are_registered():
    names = [n.split("_")[0] for n in queries.queries()]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14))
    assert set(queries.queries()) | {"pipeline"} <= set(entry_points.queries())


def folder(spark, path, **tables):
    """A folder of tables, and a DuckDB that has them as views."""
    con = duckdb.connect()
    for name, (rows, columns) in tables.items():
        spark.createDataFrame(rows, columns).repartition(2).write.parquet(f"{path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet/*.parquet'")
    return con


PAGES = [(1, None, None), (2, "no scheme", "<p>x</p>"), (3, "http://A.Example.NET/en/x", "a" * 500), (4, "http://a.example.net/de/", "a" * 500), (5, "x://net", "b"), (6, "x://NET/?q", ""),
         (7, "https://www.example.com/de/1#x", "c" * 500), (8, "https://notexample.com/de/1", "<i>" * 300), (9, "a://b://c.org/fr/", "d" * 400), (10, "http://x.org?/fr/", "d" * 400),
         (11, "http://shop.co.uk/a", "e" * 600), (12, "http://x.shop.co.uk:80/a", "f"), (13, "://", ""), (14, "http://h.test/", "g" * 900), (14, "http://h.test/", "g" * 900), (None, "http://h.test/\n/x", "g")]
PAGES += [(100 + k, f"http://bad.example.com/{k}", "<b></b>" * 50) for k in range(40)] + [(200 + k, f"http://good{k % 7}.example.com/{k}", "t" * 700) for k in range(60)]


def test_urls_equal_sql(spark, tmp_path):
    con = folder(spark, tmp_path, pages=(PAGES, "page_id long, url string, html string"))
    assert compare(spark, con, queries.op8_url_filter, SQL["op8_url_filter"], str(tmp_path)) is None
    said = {r.page_id: r.verdict for r in queries.op8_url_filter(spark, str(tmp_path)).collect()}
    assert {said[k] for k in range(100, 140)} == {"block"} and {said[k] for k in range(200, 260)} == {"allow"}


def test_reputation_shrinks_towards_its_domain(frame):
    rows = [("a.x.com", 1)] * 2 + [("b.x.com", 0)] * 50 + [("c.x.com", 0)] * 40 + [("y.com", 1)] * 90 + [("z.y.com", None)]
    known = {r.host: r for r in urls.reputations(frame(rows, "host string, good int")).collect()}
    assert 0 < known["b.x.com"].mean < known["a.x.com"].mean < known["y.com"].mean < 1
    assert known["z.y.com"].n == 0 and known["z.y.com"].mean > known["a.x.com"].mean
    assert urls.judge_urls(frame([], "page_id long, url string, good int"), queries.URL_RULES).count() == 0
    assert urls.judge_urls(frame([(1, "a://b/c", None)], "page_id long, url string, good int"), []).collect()[0].rule is None


TURNS = [(1, 0, "user", "hi"), (1, 1, "assistant", "a"), (1, 2, "user", "é"), (1, 3, "assistant", "b"), (1, 4, "user", "bye"), (2, 0, "user", "hi"), (3, 0, "system", None), (3, 1, None, "x"), (3, 2, "assistant", ""),
         (4, 1, "assistant", "same"), (4, None, "user", "q"), (4, 2, "assistant", "same"), (4, 2, "assistant", "same"), (None, 0, "user", "lost"), (5, 0, "assistant", "z" * 50_000)]


def test_preferences_equal_sql(spark, tmp_path):
    con = folder(spark, tmp_path, conversations=(TURNS, "conv_id long, turn long, role string, text string"))
    assert compare(spark, con, queries.op10_preferences, SQL["op10_preferences"], str(tmp_path)) is None


def test_prompt_is_the_common_prefix(frame):
    turn = "array<struct<role:string,text:string>>"
    a, b, c = ("user", "q"), ("assistant", "x"), ("assistant", "y")
    pairs = frame([(1, [a, b], [a, c], "n"), (2, [a, b], [a, b], "n"), (3, [a], [a, b], "n"), (4, None, [a], "n"), (5, [], [], "n"), (6, [b, a], [c, a], "n")], f"k long, chosen {turn}, rejected {turn}, prompt string")
    found = {(r.k, r.side): r for r in chat.format_preferences(pairs, "k").collect()}
    assert len(found) == 12
    assert [found[k, "chosen"].n_common_turns for k in range(1, 7)] == [1, 2, 1, 0, 0, 0]
    assert found[1, "chosen"].prompt == found[1, "rejected"].prompt == "<|im_start|>user\nq<|im_end|>\n"
    assert found[1, "rejected"].completion == "<|im_start|>assistant\ny<|im_end|>\n"
    assert found[1, "rejected"].mask == "22m,12t"
    assert found[2, "chosen"].completion == found[3, "chosen"].completion == ""


def test_exact_dedup_equals_sql_on_odd_rows(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "ab"), (6, "a  b"), (7, "é\x0bx"), (8, "éx")] + [(10 + k, "c") for k in range(50)]
    con = folder(spark, tmp_path, documents=(rows, "doc_id long, text string"))
    assert compare(spark, con, queries.op5_exact_dedup, SQL["op5_exact_dedup"], str(tmp_path)) is None


def test_empty_tables(spark, tmp_path):
    folder(spark, tmp_path, documents=([], "doc_id long, text string, lang string"), pages=([], "page_id long, url string, html string"), labels=([], "doc_id long, quality int"),
           benchmark=([], "item_id long, text string"), embeddings=([], "vec_id long, embedding array<float>"), conversations=([], "conv_id long, turn long, role string, text string"))
    for name, query in queries.queries().items():
        assert query(spark, str(tmp_path)).count() == 0, name
    assert collected(entry_points.queries()["pipeline"](spark, str(tmp_path))) == []
