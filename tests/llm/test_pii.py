import hashlib
import re

from pyspark.sql import functions as F

from tasteloom.llm import pii

SCHEMA = "doc_id long, text string, email string, kind string"
# The forms as they are given, without the guards that keep them linear.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def fine(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, form in PLAIN.items() for m in re.finditer(form, text or "") if fine(k, m.group())]


TEXTS = [
    None, "", "none here", "a@b.co, c.d+e@f-g.h.i; x@y.z%w@q.r", "@a.b a@b a@.b", "日本 ñ@x.de 😀 1.2.3.4 😀 +49 (0)30 1234-567",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.01.1.001 1.2.3", "4111 1111 1111 1111, 4111-1111-1111-1112 5500000000000004x",
    "+1 (980) 555-6268 +123 +1234567890123456 +12 34 5", "4111  1111 1111 1111 1", "a" * 50_000, "1" * 50_000,
    "a." * 20_000 + "@", "a@" + "b." * 20_000 + "c", "+" * 20_000, "+1" + " " * 20_000 + "2", "x@y.z " * 300,
]


def result(spark, texts):
    df = spark.createDataFrame([(i, t, "clash", "k") for i, t in enumerate(texts)], SCHEMA)
    rows = pii.with_identifiers(df).select("doc_id", pii.listed(F.concat(*pii.KINDS)).alias("base"), "added").collect()
    return {r["doc_id"]: r for r in rows}


def test_base_spans_equal_the_plain_forms(spark):
    got = result(spark, TEXTS)
    assert {i: r["base"] for i, r in got.items()} == {i: ",".join(brute(t)) for i, t in enumerate(TEXTS)}
    digest = hashlib.sha256(got[3]["base"].encode()).hexdigest()
    assert len(digest) == 64 and got[0]["base"] == ""


def test_addresses_with_zero_parts(spark):
    texts = [
        "10.0.0.1 192.168.0.7 127.0.0.1", "0.0.0.0 00.0.000.0", "1.00.2.3 010.020.0.0255", "0.0.0.256 0256.0.0.0 00300.1.1.1",
        "255.250.249.199 100.99.9.0", "0" * 4_000 + ".0.0.0", ".".join(["0" * 4_000 + "256"] * 4),
    ]
    got = result(spark, texts)
    assert {i: r["base"] for i, r in got.items()} == {i: ",".join(brute(t)) for i, t in enumerate(texts)}
    assert [r["base"].count("ip:") for _, r in sorted(got.items())] == [3, 2, 2, 0, 2, 1, 0]
    df = spark.createDataFrame([(1, "at 10.0.0.1 now", "e", "k")], SCHEMA)
    assert pii.with_masked(df).first()["text"] == "at [IP] now"


def test_contexts_discover_what_no_form_matches(spark):
    seeds = [f"some text here contact mailbox user{i}@site{i}.org today please" for i in range(12)]
    texts = seeds + ["we said contact mailbox user99(at)site today please", "a number 12345 elsewhere", "year 1999 was fine"]
    got = result(spark, texts)
    (span,) = got[12]["added"]
    assert span["kind"] == 0 and texts[12][span["start"]:span["stop"]] == "user99(at)site"
    assert got[13]["added"] == [] and got[14]["added"] == []


def test_rounds_go_on_until_nothing_is_added(spark):
    """A chain: each group of tokens is found by the context of the one before it."""
    often = lambda sentence: " ".join([sentence] * 20)
    texts = [often(f"ctxax user{i}@site{i}.org zz") for i in range(8)]
    for link in range(6):
        before, after = (f"ctx{'abcdefg'[n]}x" for n in (link, link + 1))
        texts += [f"{before} t{link}n{i} yy " + often(f"{after} t{link}n{i} zz") for i in range(8)]
    got = result(spark, texts)
    assert all(len(r["added"]) == 21 for i, r in got.items() if i >= 8)


def test_words_behind_long_runs_of_signs(spark):
    far = " -" * 500
    texts = [f"mailbox{far} user{i}@site{i}.org{far} please" for i in range(9)] + [f"mailbox{far} user(at)9 {far} please"]
    got = result(spark, texts)
    assert [texts[9][s["start"]:s["stop"]] for s in got[9]["added"]] == ["user(at)9"]
    long = ["x" * 300_000 + " a@b.co " + "y" * 300_000, "é- " * 100_000 + "1.2.3.4"]
    assert [r["base"].count(":") for _, r in sorted(result(spark, long).items())] == [2, 2]


def test_columns_of_any_name_pass_the_masking(spark):
    df = spark.createDataFrame([(1, "a@b.co", "x", "y", 3, 4, "z")],
                               "doc_id long, text string, key string, hash string, _key int, _spans int, spans string")
    assert [tuple(r) for r in pii.with_masked(df).collect()] == [(1, "[EMAIL]", "x", "y", 3, 4, "z")]


def test_unsure_contexts_discover_nothing(spark):
    texts = [f"write to user{i}@site.org now" for i in range(10)] + [f"write to room{i} now" for i in range(10)]
    assert all(r["added"] == [] for r in result(spark, texts).values())


def test_masking_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([
        (1, "😀 mail a@b.co or 1.2.3.4!", "e", "k"), (1, "😀 mail a@b.co or 1.2.3.4!", "e", "k"), (None, "a@b.co", "e", "k"),
        (2, None, None, None), (3, "clean", "e", "k"), (1, "other text", "e", "k")], SCHEMA)
    out = pii.with_masked(df)
    assert out.columns == df.columns
    assert sorted(str(r["text"]) for r in out.collect()) == sorted([
        "😀 mail [EMAIL] or [IP]!", "😀 mail [EMAIL] or [IP]!", "[EMAIL]", "None", "clean", "other text"])
    assert pii.with_masked(df.limit(0)).collect() == []
    assert pii.with_identifiers(df.limit(0)).collect() == []


def test_the_main_path_is_native(spark):
    df = spark.createDataFrame([(1, "a@b.co", "e", "k")], SCHEMA)
    plan = pii.with_identifiers(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
