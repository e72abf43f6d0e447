"""The five-way split of click-stream logs."""

import json

import pytest
from pyspark.sql import functions as F

from rillmart.operators import keywords, logs
from rillmart.plans import dwd

COMMON = {"mid": "m1", "is_new": "1", "os": 7}


@pytest.fixture
def split(spark):
    def run(*records, repair=False):
        df = spark.createDataFrame([(json.dumps(record),) for record in records], "value string")
        out = dwd.base_log(df) if repair else logs.tagged(logs.parse(df))
        found = {}
        for row in out.collect():
            found.setdefault(row.stream, []).append(json.loads(row.value))
        return found

    return run


def test_error_record_goes_out_whole_and_on_without_the_error(split):
    record = {"common": COMMON, "page": {"page_id": "home"}, "err": {"code": 5}, "displays": [{"a": 1}], "ts": 9}
    out = split(record)
    assert out["err"] == [record]
    assert out["page"] == [{"common": COMMON, "page": {"page_id": "home"}, "ts": 9}]
    assert out["display"] == [{"a": 1, "page": {"page_id": "home"}, "common": COMMON, "ts": 9}]


def test_start_wins_over_page(split):
    out = split({"common": COMMON, "start": {"entry": "icon"}, "page": {"page_id": "x"}, "actions": [{"b": 1}], "ts": 9})
    assert list(out) == ["start"] and out["start"][0]["start"] == {"entry": "icon"}


def test_elements_get_their_context_and_it_wins(split):
    record = {"common": COMMON, "page": {"page_id": "x"}, "ts": 9,
              "actions": [{"id": "fav", "ts": 1}, {"text": 'a "quoted" } brace\nline', "deep": {"l": [1, None]}}, {}]}
    context = {"page": {"page_id": "x"}, "common": COMMON, "ts": 9}
    assert split(record)["action"] == [
        {"id": "fav", **context}, {"text": 'a "quoted" } brace\nline', "deep": {"l": [1, None]}, **context}, context]


def test_neither_start_nor_page_gives_nothing_more(split):
    assert split({"common": COMMON, "ts": 9}) == {}
    assert list(split({"common": COMMON, "err": {"code": 1}, "displays": [{}], "ts": 9})) == ["err"]


def test_null_and_empty_fields(split):
    out = split({"common": COMMON, "err": None, "page": {"page_id": "x"}, "displays": [], "actions": None, "ts": 9})
    assert list(out) == ["page"] and "displays" not in out["page"][0]


def test_records_without_visitor_or_time_drop(split):
    page = {"page_id": "x"}
    assert split({"common": {"mid": ""}, "page": page, "ts": 9}, {"common": {}, "page": page, "ts": 9},
                 {"common": COMMON, "page": page}, {"common": COMMON, "page": page, "ts": ""}) == {}


def test_repaired_flag_is_text(split):
    def record(day, flag):
        return {"common": {"mid": "m", "is_new": flag, "os": 7}, "page": {"page_id": "x"}, "ts": day * 86_400_000 + 5}

    out = split(record(1, "1"), record(2, "1"), record(2, "0"), repair=True)
    assert sorted(r["common"]["is_new"] for r in out["page"]) == ["0", "0", "1"]
    assert all(r["common"]["os"] == 7 for r in out["page"])


def test_streams_by_name(spark):
    df = spark.createDataFrame([(json.dumps({"common": COMMON, "page": {"page_id": "x"}, "ts": 3}),)], "value string")
    parts = logs.split(logs.parse(df))
    assert set(parts) == set(logs.STREAMS)
    assert logs.pages(parts["page"]).select("mid", "page_id", "ts").first() == ("m1", "x", 3)


def test_keywords(spark, rows):
    df = spark.createDataFrame([(1, "a b A"), (2, None), (3, " -- "), (4, "Ünïcode, 42-x")], "id int, t string")
    assert rows(keywords.explode(df, "t"), "id", "keyword") == [
        (1, "a"), (1, "b"), (4, "42"), (4, "x"), (4, "ünïcode")]


def test_own_tokenizer(spark, rows):
    df = spark.createDataFrame([(1, "a|b|a")], "id int, t string")
    assert rows(keywords.explode(df, "t", lambda c: F.split(c, r"\|")), "keyword") == [("a",), ("b",)]


def test_records_of_kept_messages_are_those_parsed_at_once(spark, rows):
    """In a stream the message passes the state as one text, and its fields are read after that."""
    messages = spark.createDataFrame([(text,) for text in (
        '{"common":{"mid":"m","is_new":"1"},"page":{"a":[1,{"b":null}]},"displays":[{"x":1}],"ts":5}',
        '{"common":{"mid":"m","is_new":1,"uid":7},"start":{"e":"é"},"err":{"c":1},"ts":"6"}',
        '{"common":"m","ts":7}', '{"common":{"mid":""},"ts":8}', '{"common":{"mid":"m"},"ts":"x"}', '{"common":{"mid":{"a":1}},"ts":9}',
        '{"common":null,"ts":1}', '[1]', 'no json', '', '{"ts":3}', '{"common":{"mid":"n"},"page":"p","ts":4.0}')], "value string")
    columns = ("rec", "mid", "is_new", "ts", "et", "tie")
    assert rows(logs.records(logs.heads(messages, keep=True)), *columns) == rows(logs.parse(messages), *columns)
    assert len(rows(logs.parse(messages))) >= 3


def test_a_flag_is_replaced_in_the_text(spark):
    """Flat records were parsed and written anew, with numbers in another form; others still are, whatever their texts hold."""
    flat = ['{"mid":"m","is_new":"1","v":1.50,"n":1e2}', '{ "is_new" : 1 , "mid":"m" }', '{"mid":"is_new","is_new":"1","x":"a:b,c"}',
            '{"is_new":true}', '{"v":"is_new","is_new":"1"}', '{"is_new":"","my is_new":"1"}']
    wanted = ['{"mid":"m","is_new":"0","v":1.50,"n":1e2}', '{ "is_new" : "0" , "mid":"m" }', '{"mid":"is_new","is_new":"0","x":"a:b,c"}',
              '{"is_new":"0"}', '{"v":"is_new","is_new":"0"}', '{"is_new":"0","my is_new":"1"}']
    odd = [{"mid": "m", "is_new": "1", "in": {"is_new": "1"}}, {"is_new": "1", "v": '"is_new":"1"'}, {"is_new": "1", "v": "{}"},
           {"is_new": "1", "v": "a\\"}, {"is_new": "1", "v": ["is_new"]}, {"v": '","is_new":"5', "is_new": "1"}]
    texts = flat + [json.dumps(fields, separators=(",", ":")) for fields in odd]
    df = spark.createDataFrame([(n, text) for n, text in enumerate(texts)], "n int, common string")
    df = df.select("n", F.struct("common").alias("rec"), F.lit("0").alias("is_new"))
    got = [row.common for row in logs.with_flag(df).orderBy("n").select("rec.common").collect()]
    assert got[:len(flat)] == wanted
    assert [json.loads(text) for text in got[len(flat):]] == [{**fields, "is_new": "0"} for fields in odd]
    other = logs.with_flag(df.limit(1).withColumn("is_new", F.lit('$1"\\'))).select("rec.common").first()[0]
    assert json.loads(other)["is_new"] == '$1"\\'
