"""Columns of any name: what returns the columns it was given returns them all, with their values."""

from llm_plain import ODD_NAMES, oddly_named

from syncledger.llm import chat, language, mixing, near_dup, pii

ROWS = [(i, f"these are the plain words of a text with the number {i} in it and some more words to go", "en", "s")
        for i in range(20)] + [(20, None, None, None), (21, "", "en", None), (5, "another text of the same id", "en", "t")]


def check(out, table, rows=None):
    assert out.columns == table.columns and out.schema.simpleString() == table.schema.simpleString()
    got = out.collect()
    assert all(tuple(r)[4:] == tuple(range(len(ODD_NAMES))) for r in got)
    if rows is not None:
        assert sorted((tuple(r)[:4] for r in got), key=repr) == sorted(rows, key=repr)
    return got


def test_mixing(spark):
    table = oddly_named(spark, ROWS)
    got = check(mixing.mix_sources(table), table)
    assert {tuple(r)[:4] for r in got} <= set(ROWS) and len(got) > 5


def test_redaction(spark):
    table = oddly_named(spark, [*ROWS, (30, "write to some.one@example.com now", "en", "s")])
    model = pii.train(table.select("doc_id", "text"))
    want = [*ROWS, (30, "write to [EMAIL] now", "en", "s")]
    check(pii.redact(table, model), table, want)


def test_language(spark):
    table = oddly_named(spark, [*ROWS, (31, "these are the words of a text", None, "s")])
    model = language.train(table.select("doc_id", "text", "lang"))
    got = check(language.keep_identified(table, model), table)
    assert {r["lang"] for r in got} == {"en"} and 31 in {r["doc_id"] for r in got}


def test_near_duplicates(spark):
    table = oddly_named(spark, ROWS)
    got = check(near_dup.deduplicate(table), table)
    assert len(got) >= 4
    distinct = oddly_named(spark, [r for r in ROWS if r[1] != "another text of the same id"])
    check(near_dup.deduplicate(distinct), distinct)


def test_dialogues_by_any_key(spark):
    rows = [("x", 0, "a", "hi"), ("x", 1, "b", "ho"), (None, 0, "a", "no key"), ("", 0, "c", "empty key")]
    named = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    want = {(r[0], r[2]) for r in rows}
    assert {(r["conv_id"], r["assistant"]) for r in chat.rotate(named).collect()} == want
    dated = named.filter("conv_id IS NULL OR conv_id = 'x'").selectExpr(
        "CASE WHEN conv_id = 'x' THEN DATE'2024-01-02' END AS conv_id", "turn", "role", "text")
    assert {str(r["conv_id"]) for r in chat.rotate(dated).collect()} == {"2024-01-02", "None"}
    flagged = named.selectExpr("CASE WHEN conv_id = 'x' THEN true END AS conv_id", "turn", "role", "text")
    assert {r["conv_id"] for r in chat.rotate(flagged).collect()} == {True, None}
