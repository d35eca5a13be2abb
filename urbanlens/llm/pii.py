"""Personal data: regular expressions propose spans, checksums confirm them,
nearby context words adjust the score. DataFrame functions only.

Every kind has a pattern, a validator and a base score; context words within the
``NEAR`` characters before a match add ``CONTEXT_BONUS``. Spans that score
``THRESHOLD`` or more are reported. The base kinds (email, ip, card, phone) reach it
by their validators alone; the added kinds need their checksum (iban) or context
(national id, secret).

The patterns find leftmost non-overlapping matches in one linear pass: inner loops are
possessive (what follows a loop can never start with what the loop consumes, so
this changes no match) and a match may only start where a run starts or where the
last match ended, so very long runs are not rescanned from each position.
Offsets are code points, end exclusive.

Edge cases: NULL and empty texts have no spans; extra columns pass through;
repeated rows are judged alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.llm.common import read

NEAR = 40
CONTEXT_BONUS = 0.3
THRESHOLD = 0.5
BLOCK = 128


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    """Luhn checksum of the digits in a match."""
    rev = F.reverse(_digits(match))
    total = F.aggregate(F.sequence(F.lit(1), F.length(rev)), F.lit(0), lambda s, i: s + _luhn_digit(rev, i))
    return total % 10 == 0


def _luhn_digit(rev: Column, i: Column) -> Column:
    digit = F.substring(rev, i, F.lit(1)).cast("int")
    twice = digit * 2
    return F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)


def _mod97(match: Column) -> Column:
    """Mod-97 checksum: first four characters moved to the end, letters as 10 to 35."""
    plain = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(
        F.sequence(F.lit(1), F.length(turned)), F.lit(0),
        lambda s, i: (s * F.when(F.substring(turned, i, F.lit(1)).between("0", "9"), 10).otherwise(100) + value(F.substring(turned, i, F.lit(1)))) % 97,
    )
    return rest == 1


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # a text without this (cheap) pattern has no match
    valid: object  # Column -> Column
    score: float
    context: str  # alternatives, lower case
    mask: str


# Patterns, scores and context words.
KINDS = [
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
         lambda m: F.lit(True), 0.8, "mail|contact|write", "<EMAIL>"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]",
         lambda m: m.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]?)(?:\.|$)){4}$"), 0.6, "address|host|server", "<IP>"),
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])", r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]",
         _luhn, 0.6, "card|visa|payment", "<CARD>"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]",
         lambda m: F.length(_digits(m)).between(9, 15), 0.6, "phone|call|mobile", "<PHONE>"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])", "[A-Z][A-Z][0-9][0-9]",
         _mod97, 0.6, "iban|account|bank", "<IBAN>"),
    Kind("national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]-[0-9][0-9]-[0-9]",
         lambda m: ~m.rlike("^(?:000|666|9)|-00-|0000$"), 0.3, "ssn|social|security|taxpayer", "<ID>"),
    Kind("secret", r"(?<![A-Za-z0-9])[0-9a-fA-F]{32,128}+(?![A-Za-z0-9])", "[0-9a-fA-F]{32}",
         lambda m: m.rlike("[0-9]") & m.rlike("[a-fA-F]"), 0.3, "token|key|secret|password|bearer", "<SECRET>"),
]
BASE = ("email", "ip", "card", "phone")


def _score(kind: Kind, match: Column, gap: Column) -> Column:
    near = F.lower(F.right(gap, F.lit(NEAR))).rlike(kind.context)
    return F.when(kind.valid(match), F.lit(kind.score) + F.when(near, CONTEXT_BONUS).otherwise(0.0)).otherwise(F.lit(0.0))


def _matched(df: DataFrame, text: str, kind: Kind) -> DataFrame:
    """Add ``__gap`` (text before each match, and after the last) and ``__match``.

    They come from a generator of one row, so that the optimizer computes them once
    and never copies the expressions into what is built on them."""
    some = F.col(text).contains(kind.needs) if kind.needs == "@" else F.col(text).rlike(kind.needs)
    found = F.struct(
        F.when(some, F.split(F.col(text), kind.pattern, -1)).alias("__gap"),
        F.when(some, F.regexp_extract_all(F.col(text), F.lit(kind.pattern), 0)).alias("__match"),
    )
    return df.select(*[c for c in df.columns if c not in ("__gap", "__match")], F.inline(F.array(found)))


def _pairs(kind: Kind) -> Column:
    """(gap length, match length, score) of each match."""
    return F.zip_with(F.slice("__gap", F.lit(1), F.size("__match")), "__match", lambda g, m: F.struct(
        F.length(g).alias("gap"), F.length(m).alias("len"), F.round(_score(kind, m, g), 2).alias("score"),
    ))


def detect(docs: DataFrame, name: str = "pii", threshold: float = THRESHOLD) -> DataFrame:
    """Add ``name``: array of (kind, start, end, score), by kind as listed, then start."""
    df, parts = docs.withColumn("__text", F.coalesce(F.col("text"), F.lit(""))), []
    for at, kind in enumerate(KINDS):
        df = _matched(df, "__text", kind).withColumn(f"__p{at}", _pairs(kind)).withColumn(f"__s{at}", _placed(f"__p{at}", kind.name, threshold))
        parts.append(f"__s{at}")
    out = df.withColumn(name, F.concat(*[F.coalesce(F.col(p), F.array().cast(_TYPE)) for p in parts]))
    return out.select(*[c for c in docs.columns if c != name], name)


_TYPE = "array<struct<kind:string,start:int,end:int,score:double>>"


def _placed(pairs: str, kind: str, threshold: float) -> Column:
    """``pairs`` (gap, len, score) to spans: inside a block of ``BLOCK`` matches a fold
    appends to a short array; an outer fold joins the blocks."""
    block = f"slice({pairs}, b * {BLOCK} + 1, {BLOCK})"
    inner = f"""aggregate({block}, struct(s.at as at, cast(array() as {_TYPE}) as out), (t, x) -> struct(
        t.at + x.gap + x.len as at,
        if(x.score >= {threshold}, concat(t.out, array(struct('{kind}' as kind, t.at + x.gap as start, t.at + x.gap + x.len as end, x.score as score))), t.out) as out))"""
    outer = f"""aggregate(sequence(0, (size({pairs}) - 1) div {BLOCK}), struct(0 as at, cast(array() as array<{_TYPE}>) as blocks),
        (s, b) -> element_at(transform(array({inner}), r -> struct(r.at as at, concat(s.blocks, array(r.out)) as blocks)), 1), s -> flatten(s.blocks))"""
    return F.expr(f"if(size({pairs}) > 0, {outer}, cast(array() as {_TYPE}))")


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Replace every reported match in ``text`` by its kind's mask, kind by kind."""
    df = docs
    for kind in KINDS:
        masked = F.zip_with(F.slice("__gap", F.lit(1), F.size("__match")), "__match", lambda g, m: F.concat(g, F.when(_score(kind, m, g) >= threshold, F.lit(kind.mask)).otherwise(m)))  # noqa: B023
        df = _matched(df, "text", kind).withColumn("text", F.when(F.size("__match") > 0, F.concat(F.array_join(masked, ""), F.element_at("__gap", -1))).otherwise(F.col("text")))
    return df.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(spans_text(F.filter("pii", lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"),
        spans_text(F.col("pii")).alias("spans"),
    )


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: reported spans are masked in ``text``; ``n_chars`` follows."""
    return redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)
