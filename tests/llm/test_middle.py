"""Fill-in-middle against a plain loop over units."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assocframe.llm import middle
from assocframe.llm.queries import QUERIES

LETTERS = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def plain_units(text):
    units = []
    for c in text:
        if units and c in LETTERS and units[-1][-1] in LETTERS:
            units[-1] += c
        else:
            units.append(c)
    return units


def plain(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = plain_units(text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@settings(deadline=None, max_examples=200)
@given(st.text(alphabet="abZ .é\n<", max_size=60), st.integers(1, 9))
def test_ends_are_the_units_ends(text, piece):
    ends, at = [], 0
    for unit in plain_units(text):
        at += len(unit)
        ends.append(at)
    assert middle.unit_ends(text).tolist() == ends
    assert middle.unit_ends(text, piece).tolist() == ends  # however the text is cut into pieces


def test_very_long_texts():
    text = "some words, é " * 300_000 + "x" * 3_000_000
    ends = middle.unit_ends(text)
    assert len(ends) == 300_000 * 7 + 1 and ends[-1] == len(text)


def key(row):
    return tuple((x is None, x) for x in row)


def check(df):
    got = middle.fill_in_middle(df).withColumn("restored", middle.restored_text()).collect()
    rows = df.select("doc_id", "text").collect()
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted((plain(*r) for r in rows), key=key)
    back = sorted(((r["doc_id"], r["restored"]) for r in got), key=key)
    assert back == sorted(((d, t or "") for d, t in rows), key=key)


def test_whole_table(docs):
    check(docs)


def test_odd_documents(odd):
    check(odd)


def test_markers_at_the_seams(spark):
    texts = ["<", "<P", "<S<M", "a<P>b", "P>x<S", "S>M>P>", "<<P", "M><M", "<S>", "a<M>"] * 12
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_shares_are_parameters(docs):
    forms = {r["form"] for r in middle.fill_in_middle(docs, 0, 100).select("form").distinct().collect()}
    assert forms == {"spm"}
    assert {r["form"] for r in middle.fill_in_middle(docs, 100).select("form").distinct().collect()} == {"plain"}


def test_text_ids(spark):
    check(spark.createDataFrame([("a-1", "some text"), ("b", None)], "doc_id string, text string"))


def test_empty_table(none):
    assert middle.fill_in_middle(none).isEmpty()


def test_query(spark, small, docs):
    got = QUERIES["op11_fill_in_middle"](spark, small)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    whole = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("restored_sha256"))
    assert got.select("doc_id", "restored_sha256").exceptAll(whole).isEmpty() and got.count() == docs.count()


def test_one_task_for_each_batch(docs):
    plan = middle.fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("n", [0, 1])
def test_shortest(n):
    assert middle.cut("a" * n, 5, 7)[0] == n
