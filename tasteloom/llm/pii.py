"""Personal data: patterned identifiers, and others found by the contexts that surround them.

Base identifiers are matched by expressions and checked. The words around them induce lexical patterns;
patterns and the tokens they surround form a graph on which confidence goes back and forth: a pattern is
as sure as its tokens, a token as sure as its patterns. Tokens that sure patterns surround are
identifiers too, though no expression matches them. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.sources.scratch import cut

KINDS = ("email", "ip", "card", "phone")

# The four forms. Possessive repeats and guards at the front change no match; they keep
# the search linear: a match can only start where its run of characters starts, or where the last ended.
_MAIL = r"[A-Za-z0-9._%+-]"
FORMS = {
    "email": rf"(?:\G|(?<!{_MAIL})){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_BYTE = r"(?:0*+(?:1[0-9][0-9]|2[0-4][0-9]|25[0-5]|[1-9][0-9]?)|0++)"
IP_FINE = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"

# A token that could be an identifier: no white space, with a digit or an at sign.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
SURE, SUPPORT = 0.9, 5
# Rounds go on while a token is added or one's trust rises by more than this.
STEP = 1e-3

SPAN = "array<struct<kind:int,start:int,stop:int>>"


def _ends(gaps: Column, found: Column) -> Column:
    """End of each match: the lengths of all gaps and matches up to it, in characters."""
    lengths = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.length(g) + F.length(m))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("ends"))
    return F.aggregate(
        lengths, start,
        lambda a, n: F.struct((a["at"] + n).alias("at"), F.array_append(a["ends"], a["at"] + n).alias("ends")),
        lambda a: a["ends"],
    )


def _all(text: Column, form: str) -> tuple[Column, Column]:
    """(matches, texts between them) of an expression over the whole text."""
    return F.regexp_extract_all(text, F.lit(form), F.lit(0)), F.split(text, form, -1)


def _luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn test."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    doubled = F.transform(
        values, lambda d, i: F.when(i % 2 == 0, d).when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(IP_FINE)
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _words_before(gap: Column) -> Column:
    """The last word of a text, in lower case without signs; empty where there is none.

    A match begins where a word does and never gives back, so the whole text is read once.
    """
    return F.lower(F.regexp_extract(gap, r"(?<!\p{L})([\p{L}]++)[^\p{L}]*+$", 1))


def _words_after(gap: Column) -> Column:
    return F.lower(F.regexp_extract(gap, r"^[^\p{L}]*+([\p{L}]++)", 1))


def _matches(df: DataFrame, kind: str, number: int) -> DataFrame:
    """Adds the column ``kind``: all checked matches with their places and the words around them."""
    text, need = F.col("_text"), NEEDS[kind]
    there = F.contains(text, F.lit(need)) if need else text.rlike("[0-9]")
    form = FORMS[kind]
    df = df.withColumn("_found", F.when(there, F.regexp_extract_all(text, F.lit(form), F.lit(0))))
    df = df.withColumn("_gaps", F.when(F.size("_found") > 0, F.split(text, form, -1)))
    df = df.withColumn("_ends", F.when(F.size("_found") > 0, _ends(F.col("_gaps"), F.col("_found"))))
    rows = F.transform(
        F.arrays_zip("_found", "_ends"),
        lambda m, i: F.struct(
            F.lit(number).alias("kind"), (m["_ends"] - F.length(m["_found"])).alias("start"), m["_ends"].alias("stop"),
            m["_found"].alias("value"), _words_before(F.get(F.col("_gaps"), i)).alias("left"),
            _words_after(F.get(F.col("_gaps"), i + 1)).alias("right"),
        ),
    )
    kept = F.filter(rows, lambda m: valid(kind, m["value"]))
    empty = F.array().cast(
        "array<struct<kind:int,start:int,stop:int,value:string,left:string,right:string>>"
    )
    return df.withColumn(kind, F.coalesce(kept, empty)).drop("_found", "_gaps", "_ends")


def base_matches(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with one array per kind, and ``token``: tokens that could be identifiers but touch none."""
    df = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    for number, kind in enumerate(KINDS):
        df = _matches(df, kind, number)
    found, gaps = _all(F.col("_text"), TOKEN)
    df = df.withColumn("_found", F.when(F.col("_text").rlike("[0-9@]"), found))
    df = df.withColumn("_gaps", F.when(F.size("_found") > 0, gaps))
    df = df.withColumn("_ends", F.when(F.size("_found") > 0, _ends(F.col("_gaps"), F.col("_found"))))
    base = F.concat(*KINDS)
    rows = F.transform(
        F.arrays_zip("_found", "_ends"),
        lambda m, i: F.struct(
            F.lit(-1).alias("kind"), (m["_ends"] - F.length(m["_found"])).alias("start"), m["_ends"].alias("stop"),
            m["_found"].alias("value"), _words_before(F.get(F.col("_gaps"), i)).alias("left"),
            _words_after(F.get(F.col("_gaps"), i + 1)).alias("right"),
        ),
    )
    free = F.filter(rows, lambda t: ~F.exists(base, lambda b: (b["start"] < t["stop"]) & (b["stop"] > t["start"])))
    empty = F.array().cast(
        "array<struct<kind:int,start:int,stop:int,value:string,left:string,right:string>>"
    )
    return df.withColumn("token", F.coalesce(free, empty)).drop("_found", "_gaps", "_ends", "_text")


def _edges(matched: DataFrame) -> DataFrame:
    """(pattern, kind, value, n): how often a pattern surrounds a value; kind -1 is not known.

    A pattern is the word before, the word after, or both.
    """
    seen = matched.select(F.explode(F.concat(*KINDS, "token")).alias("m")).select("m.kind", "m.value", "m.left", "m.right")
    left, right = F.col("left"), F.col("right")
    patterns = F.array_compact(F.array(
        F.when(left != "", F.concat(left, F.lit(" _"))),
        F.when(right != "", F.concat(F.lit("_ "), right)),
        F.when((left != "") & (right != ""), F.concat(left, F.lit(" _ "), right)),
    ))
    return seen.select(F.explode(patterns).alias("pattern"), "kind", "value").groupBy("pattern", "kind", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def discover(matched: DataFrame, sure: float = SURE, support: int = SUPPORT, step: float = STEP) -> DataFrame:
    """(value, kind, trust): tokens taken for identifiers by the patterns around them.

    A pattern's trust in a kind is the share of what it surrounds that is of the kind, weighed by the
    trust in it; it counts from ``support`` different values on. A token's trust is the chance that not
    all its patterns err, where a pattern that does not count stays silent. Rounds alternate until no token is
    added and none's trust rises by more than ``step``. A token keeps its first kind and its highest trust, so rounds
    come to an end; the number of rows in the graph never grows.
    """
    edges = cut(_edges(matched), "edges")
    # Distinct values per pattern and what it surrounds in all do not change.
    weight = F.col("n").cast("double")
    around = edges.groupBy("pattern").agg(F.sum(weight).alias("all"))
    seeds = edges.where("kind >= 0").groupBy("pattern", "kind").agg(
        F.sum(weight).alias("sure"), F.count(F.lit(1)).alias("values")
    )
    unknown = edges.where("kind = -1").select("pattern", "value", "n")
    tokens = edges.sparkSession.createDataFrame([], "value string, kind int, trust double")
    while True:
        more = unknown.join(tokens, "value").groupBy("pattern", "kind").agg(
            F.sum(F.col("n") * F.col("trust")).alias("sure"), F.count(F.lit(1)).alias("values")
        )
        trusted = seeds.unionByName(more).groupBy("pattern", "kind").agg(
            F.sum("sure").alias("sure"), F.sum("values").alias("values")
        )
        scored = trusted.join(around, "pattern").where(F.col("values") >= support).select(
            "pattern", "kind", (F.col("sure") / F.col("all")).alias("p")
        )
        scored = cut(scored.where(F.col("p") > 0.5), "patterns")
        err = F.exp(F.sum(F.log(F.greatest(1 - F.col("p"), F.lit(1e-6)))))
        believed = unknown.join(scored, "pattern").groupBy("value", "kind").agg((1 - err).alias("trust"))
        # One kind per token: the surest, the first listed of equals.
        best = believed.groupBy("value").agg(F.max(F.struct("trust", (-F.col("kind")).alias("minus"))).alias("b"))
        now = best.select("value", (-F.col("b.minus")).alias("k"), F.col("b.trust").alias("t")).where(F.col("t") >= sure)
        both = now.join(tokens, "value", "full")
        rises = F.coalesce(F.when(F.col("kind") != F.col("k"), 0.0).otherwise(F.col("t") - F.col("trust")), F.lit(0.0))
        after = cut(both.select(
            "value", F.coalesce("kind", "k").alias("kind"), (F.coalesce("trust", "t") + F.greatest(rises, F.lit(0.0))).alias("trust"),
            (F.col("kind").isNull() | (rises > step)).alias("changed"),
        ), "tokens")
        tokens = after.drop("changed")
        if after.where("changed").isEmpty():
            return tokens


def with_identifiers(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text_hash, email, ip, card, phone, added): spans per row and kind, ``added`` from contexts.

    Arrays of (kind, start, stop) in characters of the whole text, in order. Null texts count as empty
    and have none. Rows are told apart by key and text; repeated rows get equal answers. An
    empty table gives no rows. Other columns are dropped.
    """
    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"))
    matched = cut(base_matches(own, "text").drop("text"), "matched")
    tokens = discover(matched)
    occurrences = matched.select("key", "text_hash", F.explode("token").alias("t"))
    hits = occurrences.select("key", "text_hash", F.col("t.value").alias("value"), "t.start", "t.stop").join(tokens, "value")
    # The spans of one row: at most as many as its text has tokens.
    added = hits.groupBy("key", "text_hash").agg(F.array_sort(F.collect_set(F.struct("kind", "start", "stop"))).alias("added"))
    added = added.select(F.col("key").alias("_key"), F.col("text_hash").alias("_hash"), "added")
    joined = matched.drop("token").join(added, F.col("key").eqNullSafe(F.col("_key")) & (F.col("text_hash") == F.col("_hash")), "left")
    spans = [F.transform(k, lambda m: F.struct(m["kind"], m["start"], m["stop"])).cast(SPAN).alias(k) for k in KINDS]
    return joined.select(
        F.col("key").alias(key), "text_hash", *spans, F.coalesce("added", F.array().cast(SPAN)).cast(SPAN).alias("added")
    )


def listed(spans: Column) -> Column:
    """``kind:start:stop`` of spans in order, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")),
        ),
        ",",
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; spans that overlap are joined into one.

    Joined spans take the kind of the first.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["stop"], s["kind"])))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    body = F.coalesce(text, F.lit(""))
    joined = F.aggregate(
        by_place, start,
        lambda a, s: F.when(
            s["start"] < a["at"],
            F.struct(F.greatest(a["at"], s["stop"]).alias("at"), a["parts"].alias("parts")),
        ).otherwise(
            F.struct(
                s["stop"].alias("at"),
                F.concat(a["parts"], F.array(F.substring(body, a["at"] + 1, s["start"] - a["at"]), F.get(names, s["kind"]))).alias("parts"),
            )
        ),
        lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(body, a["at"] + 1, F.length(body))),
    )
    return F.when(F.size(spans) == 0, text).otherwise(joined)


def with_masked(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every identifier in ``text`` replaced by its kind in brackets; all rows stay.

    Null texts stay null. Repeated rows are masked alike.
    """
    found = with_identifiers(docs, key, text)
    spans = F.concat(*KINDS, "added")
    held = found.where(F.size(spans) > 0).select(F.col(key).alias("key"), F.col("text_hash").alias("hash"), spans.alias("spans"))
    held = held.dropDuplicates(["key", "hash"]).alias("held")
    # Frames have names here, so columns of ``docs`` may have any.
    own, body = docs.alias("own"), F.col(f"own.`{text}`")
    same = F.col(f"own.`{key}`").eqNullSafe(F.col("held.key")) & (F.xxhash64(F.coalesce(body, F.lit(""))) == F.col("held.hash"))
    changed = F.when(F.col("held.spans").isNull(), body).otherwise(masked(body, F.col("held.spans"))).alias(text)
    return own.join(held, same, "left").select(*[changed if c == text else F.col(f"own.`{c}`") for c in docs.columns])
