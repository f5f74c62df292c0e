"""Personal data by weak supervision, in DataFrame functions alone.

Patterns propose spans. Labelers of three sorts vote on each span or abstain: regex labelers on its shape, a
gazetteer labeler on cue words before it, context labelers on what surrounds it. Expectation-maximisation over
the counts of equal vote patterns estimates how reliable each labeler is and how likely each pattern is personal
data; these likelihoods are the soft labels of a logistic span classifier on votes, kind and length, whose
weights become a column expression. Base kinds are always reported; the classifier decides on the further kinds.

Vote patterns are summed before they reach the driver: a table bounded by votes, kinds and length classes, not
by the data. Texts are neither shuffled nor stored. Patterns use possessive repeats and start only where a run
starts, so that long runs take linear time and no deep recursion.

Defined results: a null text is an empty one; without spans counts are 0, texts of spans empty; where nothing is
proposed at all fixed starting weights are used; repeated rows are searched alike; other columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creamline.llm.common import as_row, row_columns, table

_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: A run starts here, or the last match ended here inside it.
_RUN = rf"(?:(?<!{_LOCAL})|\G)"
#: Kind: pattern. The first four are the base kinds, in the order in which they are reported.
BASE = {
    "email": rf"{_RUN}{_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
MORE = {
    "local_phone": r"(?<![0-9+)(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+",
    "spelled_email": rf"{_RUN}{_LOCAL}++ ?[(\[]at[)\]] ?{_HOST}++(?:(?:\.| ?[(\[]dot[)\]] ?){_HOST}++)++",
}
#: Cue words in front of each kind.
CUES = {
    "email": ("mail", "contact", "correo", "write to"),
    "spelled_email": ("mail", "contact", "correo", "write to"),
    "phone": ("phone", "tel", "call", "fax", "mobile"),
    "local_phone": ("phone", "tel", "call", "fax", "mobile"),
    "ip": ("ip", "host", "server", "address", "addr"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "secret": ("token", "key", "secret", "password", "passwd", "pwd", "bearer"),
}
VOTES = ("shape", "cue", "alone", "quiet", "varied")
SPAN = "struct<kind:string,start:bigint,end:bigint,value:string>"


def _value_filter(kind: str, value: Column) -> Column:
    """Whether a match of a base kind counts; failing ones are dropped."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "card":
        turned = F.reverse(digits)
        total = F.aggregate(
            F.sequence(F.lit(1), F.length(digits)), F.lit(0),
            lambda sum_, i: sum_ + _luhn(F.substring(turned, i, F.lit(1)).cast("int"), i),
        )
        return F.when(F.length(digits).between(16, 19), total % 10 == 0).otherwise(False)
    if kind == "secret":
        return value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    return F.lit(True)


def _luhn(digit: Column, place: Column) -> Column:
    twice = digit * 2
    return F.when(place % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))


def _spans(kind: str, matches: Column, between: Column) -> Column:
    """Spans by code points: each match starts after all texts between and all matches before it."""
    empty = F.expr(f"cast(array() as array<{SPAN}>)")

    def add(done: Column, i: Column) -> Column:
        value = F.get(matches, i)
        start = done["at"] + F.length(F.get(between, i))
        end = start + F.length(value)
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), value.alias("value"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

    walked = F.aggregate(
        F.sequence(F.lit(0), F.size(matches) - 1), F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("out")), add, lambda done: done["out"]
    )
    return F.when(F.size(matches) > 0, F.filter(walked, lambda s: _value_filter(kind, s["value"]))).otherwise(empty)


def proposed(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with base and more, arrays of proposed spans; further spans that touch a base span are left out."""
    rows = docs.withColumn("pii_text", F.coalesce(F.col(text), F.lit("")))
    has = {
        "email": F.col("pii_text").contains("@"),
        "spelled_email": F.col("pii_text").contains("at)") | F.col("pii_text").contains("at]"),
    }
    digit = F.col("pii_digit")
    rows = rows.withColumn("pii_digit", F.col("pii_text").rlike("[0-9]"))
    patterns = BASE | MORE
    nothing = F.expr("cast(array() as array<string>)")
    rows = rows.withColumns({
        f"pii_m_{kind}": F.when(has.get(kind, digit), F.regexp_extract_all("pii_text", F.lit(p), F.lit(0))).otherwise(nothing)
        for kind, p in patterns.items()
    })
    rows = rows.withColumns({
        f"pii_b_{kind}": F.when(F.size(f"pii_m_{kind}") > 0, F.split("pii_text", p, -1)).otherwise(nothing) for kind, p in patterns.items()
    })
    rows = rows.withColumns({f"pii_s_{kind}": _spans(kind, F.col(f"pii_m_{kind}"), F.col(f"pii_b_{kind}")) for kind in patterns})
    rows = rows.withColumn("pii_base", F.concat(*[f"pii_s_{k}" for k in BASE]))
    rows = rows.withColumn("pii_more", F.filter(
        F.concat(*[f"pii_s_{k}" for k in MORE]),
        lambda s: ~F.exists("pii_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    ))
    return rows.drop("pii_digit", *[f"pii_{c}_{k}" for c in "mbs" for k in patterns])


def _votes(span: Column, text: Column) -> list[Column]:
    """1 for personal data, 0 against, -1 abstains; in the order of VOTES."""
    kind, value = span["kind"], span["value"]
    before = F.lower(F.substring(text, F.greatest(span["start"] - 29, F.lit(1)).cast("int"), F.least(span["start"], F.lit(30)).cast("int")))
    after = F.substring(text, (span["end"] + 1).cast("int"), F.lit(30))
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    letters = F.length(F.regexp_replace(value, "[^A-Za-z]", ""))
    shape = (
        F.when(kind.isin("email", "spelled_email"), value.rlike("[A-Za-z]{2,24}$"))
        .when(kind == "ip", ~value.rlike(r"(^|\.)0[0-9]"))
        .when(kind == "card", value.rlike("^[2-6]"))
        .when(kind == "secret", (4 * digits >= F.length(value)) & (8 * letters >= F.length(value)))
        .otherwise(digits >= 10)
    )
    cue = reduce(
        lambda case, k: case.when(kind == k, before.rlike("(" + "|".join(CUES[k]) + r")[^\n]{0,12}$")),
        CUES, F.when(F.lit(False), F.lit(False)),
    )
    alone = ~before.rlike(r"[\p{L}\p{N}_]$") & ~after.rlike(r"^[\p{L}\p{N}_]")
    around = F.length(F.regexp_replace(F.concat(before, after), "[^0-9]", ""))
    varied = F.size(F.array_distinct(F.split(F.substring(value, 1, 64), ""))) >= 5
    return [
        F.when(shape, 1).otherwise(0), F.when(cue, 1).otherwise(-1), F.when(alone, 1).otherwise(0),
        F.when(around > 24, 0).when(around < 12, 1).otherwise(-1), F.when(varied, 1).otherwise(0),
    ]


def _features(span: Column, text: Column) -> Column:
    """What the classifier sees of a span, each one of few values."""
    votes = [v.alias(name) for name, v in zip(VOTES, _votes(span, text), strict=True)]
    size = span["end"] - span["start"]
    length = F.when(size < 14, "short").when(size < 24, "middle").when(size < 64, "long").otherwise("very long")
    return F.struct(span["kind"].alias("kind"), length.alias("length"), *votes)


def patterns_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """Feature values of all proposed spans, with how many spans have them."""
    rows = proposed(docs.select(text), text)
    # a filter before the explode would be pushed down with all of the span expressions and repeat them
    spans = rows.select("pii_text", F.explode_outer(F.concat("pii_base", "pii_more")).alias("span")).filter("span IS NOT NULL")
    return spans.select(_features(F.col("span"), F.col("pii_text")).alias("f")).groupBy("f").agg(F.count("*").alias("n")).select("f.*", "n")


def reliabilities(patterns: list[dict], rounds: int = 50) -> tuple[list[float], dict]:
    """Expectation-maximisation: the likelihood of each pattern, and P(vote | class) of each labeler."""
    values = (-1, 0, 1)
    likely = [min(max(0.5 + 0.2 * sum((p[v] > 0) - (p[v] == 0) for v in VOTES), 0.05), 0.95) for p in patterns]
    rates: dict = {}
    for _ in range(rounds):
        total = {c: sum(p["n"] * (q if c else 1 - q) for p, q in zip(patterns, likely, strict=True)) for c in (0, 1)}
        rates = {
            (v, x, c): (1 + sum(p["n"] * (q if c else 1 - q) for p, q in zip(patterns, likely, strict=True) if p[v] == x)) / (3 + total[c])
            for v in VOTES for x in values for c in (0, 1)
        }
        prior = (1 + total[1]) / (2 + total[0] + total[1])
        odds = [
            math.log(prior / (1 - prior)) + sum(math.log(rates[v, p[v], 1] / rates[v, p[v], 0]) for v in VOTES) for p in patterns
        ]
        likely = [1 / (1 + math.exp(-min(max(o, -30), 30))) for o in odds]
    return likely, rates


def _names(pattern: dict) -> list[str]:
    return ["bias", f"kind={pattern['kind']}", f"length={pattern['length']}", *(f"{v}={pattern[v]}" for v in VOTES)]


#: Used where no span is proposed at all.
START = {"bias": -1.5, "shape=1": 1.0, "alone=1": 1.0, "cue=1": 1.5, "varied=0": -2.0}


def train(patterns: list[dict], rounds: int = 400) -> dict[str, float]:
    """Weights of the span classifier, learned from the likelihoods of the patterns by gradient descent."""
    patterns = sorted(patterns, key=lambda p: tuple(map(str, p.values())))
    if not patterns:
        return dict(START)
    likely, _ = reliabilities(patterns)
    total = sum(p["n"] for p in patterns)
    weights = {name: 0.0 for p in patterns for name in _names(p)}
    for _ in range(rounds):
        step = {name: -1e-4 * w for name, w in weights.items()}
        for p, q in zip(patterns, likely, strict=True):
            names = _names(p)
            miss = q - 1 / (1 + math.exp(-sum(weights[name] for name in names)))
            for name in names:
                step[name] += miss * p["n"] / total
        weights = {name: w + 2.0 * step[name] for name, w in weights.items()}
    return weights


def fit(docs: DataFrame, text: str = "text") -> dict[str, float]:
    """The classifier of the corpus. Only summed patterns reach the driver."""
    return train([row.asDict() for row in patterns_of(docs, text).collect()])


def chance(span: Column, text: Column, weights: dict[str, float]) -> Column:
    """The classifier's probability that a span is personal data."""
    f = _features(span, text)
    logit = F.lit(weights.get("bias", 0.0))
    for name in ("kind", "length", *VOTES):
        own = {k.split("=", 1)[1]: w for k, w in weights.items() if k.startswith(name + "=")}
        for value, w in own.items():
            logit = logit + F.when(f[name].cast("string") == value, w).otherwise(0.0)
    return 1 / (1 + F.exp(-logit))


def personal_data(docs: DataFrame, weights: dict[str, float], text: str = "text") -> DataFrame:
    """The rows with pii_text, pii_base and pii_more; the latter holds the spans that the classifier accepts."""
    rows = proposed(docs, text)
    accepted = F.filter("pii_more", lambda s: chance(s, F.col("pii_text"), weights) >= 0.5)
    return rows.withColumn("pii_more", F.when(F.size("pii_more") > 0, accepted).otherwise(F.col("pii_more")))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def redacted(docs: DataFrame, weights: dict[str, float], text: str = "text") -> DataFrame:
    """The rows with every span of their text replaced by its kind in brackets; touching spans become one.

    All other columns stay as they are, whatever their names.
    """
    source = "source_text"
    rows = personal_data(docs.select(as_row(docs), F.col(text).alias(source)), weights, source)
    spans = F.array_sort(F.transform(F.concat("pii_base", "pii_more"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    body = F.col("pii_text")

    def add(done: Column, s: Column) -> Column:
        fresh = F.concat(
            done["out"],
            F.array(F.substring(body, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int")), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))),
        )
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.when(s["start"] < done["at"], done["out"]).otherwise(fresh).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    whole = F.aggregate(
        spans, start, add,
        lambda done: F.concat(F.array_join(done["out"], ""), F.substring(body, (done["at"] + 1).cast("int"), F.length(body))),
    )
    some = F.size("pii_base") + F.size("pii_more") > 0
    return rows.select(*row_columns(docs, **{text: F.when(some, whole).otherwise(F.col(source))}))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data(docs, fit(docs))
    counts = [F.size(F.filter("pii_base", _of_kind(kind))).cast("long").alias(f"n_{kind}") for kind in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(_listed(F.col("pii_base")), 256).alias("base_sha256"),
        _listed(F.concat("pii_base", "pii_more")).alias("spans"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to its kind; n_chars counts the new text."""
    length = F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return redacted(docs, fit(docs)).withColumn("n_chars", length)
