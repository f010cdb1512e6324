"""Personal data spans (DataFrame functions only): patterns propose, checksums confirm, context words adjust the score.

Base kinds (email, ip, card, phone) follow fixed patterns with a check each
(parts up to 255, Luhn, digit counts); a base span that passes is always kept.
Added kinds are kept when their score reaches ``threshold``:
  iban         mod-97 must hold; 0.6
  local_phone  national number without "+"; 0.3
and a context word of the kind within 40 characters before the span adds 0.3
(also to base scores, from 0.6).

Positions come from the text between matches: ``split`` and
``regexp_extract_all`` walk the same matches, so running sums of their lengths
in code points are the offsets.  The patterns are written with possessive
quantifiers and start guards that match the same spans in linear time.

Defined cases: NULL counts as the empty text and has no spans; every row is
treated alone, repeated or not; texts of any length are scanned whole; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import column, pinned

LOCAL = "[A-Za-z0-9._%+-]"
# fixed values: kind -> (pattern, cheap test that it may occur, context words)
BASE = {
    "email": (rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", "mail|contact|write"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", "ip|address|host|server"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"(?:[0-9][\x20-]?){16}", "card|visa|master|credit|payment"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", "tel|phone|call|fax|mobile"),
}
ADDED = {
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}",
             "iban|bank|account"),
    "local_phone": (r"(?<![0-9+().-])(?<!\+[0-9]{1,3}\x20)(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9.-])",
                    r"[0-9]{3}[\x20.-][0-9]{3}", "tel|phone|call|fax|mobile"),
}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
BLOCK = 256


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def characters(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda ch: ch != "")


def luhn(number: Column) -> Column:
    """True when a string of digits passes the Luhn check."""
    backwards = characters(F.reverse(number))
    value = F.transform(backwards, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(value, F.lit(0), lambda a, v: a + v) % 10 == 0


def mod97(code: Column) -> Column:
    """True when an account code passes the ISO 7064 mod 97-10 check (first four characters go last)."""
    plain = F.regexp_replace(code, "\\x20", "")
    turned = F.concat(F.substring(plain, 5, 100), F.substring(plain, 1, 4))
    return F.aggregate(characters(turned), F.lit(0), lambda a, ch: F.when(
        ch.rlike("[0-9]"), (a * 10 + F.coalesce(ch.try_cast("int"), F.lit(0))) % 97).otherwise((a * 100 + F.ascii(ch) - 55) % 97)) == 1


def passes(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(f"^{PART}(?:\\.{PART}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits(match)).between(16, 19), luhn(digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits(match)).between(8, 15)
    if kind == "iban":
        return F.when(F.length(F.regexp_replace(match, "\\x20", "")).between(15, 34), mod97(match)).otherwise(F.lit(False))
    return F.lit(True)


def running_sums(values: Column) -> Column:
    """Inclusive running sums of an int array, in blocks so that long arrays stay near linear."""
    empty = F.array().cast("array<int>")

    def inside(block: Column, start: Column) -> Column:
        return F.aggregate(block, F.struct(start.alias("t"), empty.alias("out")), lambda s, v: F.struct(
            (s["t"] + v).alias("t"), F.concat(s["out"], F.array(s["t"] + v)).alias("out")))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")),
                         lambda b: F.slice(values, b * BLOCK + 1, BLOCK))
    state = F.struct(F.lit(0).alias("t"), F.array().cast("array<array<int>>").alias("out"))
    return F.when(F.size(values) == 0, empty).otherwise(F.flatten(F.aggregate(blocks, state, lambda s, b: F.struct(
        (s["t"] + F.aggregate(b, F.lit(0), lambda a, v: a + v)).alias("t"),
        F.concat(s["out"], F.array(inside(b, s["t"])["out"])).alias("out")))["out"]))


def spans_of(rows: DataFrame, text: str, kind: str, pattern: str, hint: str, words: str, score: float) -> DataFrame:
    """Adds column ``kind``: array of (kind, start, end, score) of the matches that pass their check."""
    may = F.col(text).rlike(hint)
    rows = pinned(rows, _m=F.when(may, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    rows = pinned(rows, _p=F.when(F.size("_m") > 0, F.split(F.col(text), pattern, -1)).otherwise(F.array().cast("array<string>")))
    gaps = F.transform("_m", lambda m, i: F.length(F.get("_p", i)) + F.when(i > 0, F.length(F.get("_m", i - 1))).otherwise(F.lit(0)))
    rows = pinned(rows, _s=running_sums(gaps))
    found = F.transform("_m", lambda m, i: F.struct(
        F.lit(kind).alias("kind"), F.get("_s", i).alias("start"), (F.get("_s", i) + F.length(m)).alias("end"),
        (F.lit(score) + F.when(F.lower(F.right(F.get("_p", i), F.lit(40))).rlike(words), 0.3).otherwise(0.0)).alias("score"),
        passes(kind, m).alias("ok")))
    kept = F.transform(F.filter(found, lambda s: s["ok"]), lambda s: F.struct(s["kind"], s["start"], s["end"], s["score"]))
    return pinned(rows, **{kind: F.when(F.size("_m") > 0, kept).otherwise(
        F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>"))}).drop("_m", "_p", "_s")


def find_pii(docs: DataFrame, threshold: float = 0.6) -> DataFrame:
    """doc_id, base (array of kind, start, end, score), spans (base and accepted added spans): one row per document."""
    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), F.coalesce(column(docs, "text", "string"), F.lit("")).alias("_text"))
    # no pattern can match without a digit or an @; such texts, most of them, skip the rest
    some, none = rows.filter(F.col("_text").rlike("[0-9@]")), rows.filter(~F.col("_text").rlike("[0-9@]"))
    for kind, (pattern, hint, words) in BASE.items():
        some = spans_of(some, "_text", kind, pattern, hint, words, 0.6)
    for kind, (pattern, hint, words) in ADDED.items():
        some = spans_of(some, "_text", kind, pattern, hint, words, 0.6 if kind == "iban" else 0.3)
    added = F.filter(F.concat(*ADDED), lambda s: s["score"] >= threshold - 1e-9)
    some = some.select("doc_id", *BASE, F.concat(*BASE).alias("base"), F.concat(*BASE, added).alias("spans"))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")
    return some.unionByName(none.select("doc_id", *[empty.alias(c) for c in (*BASE, "base", "spans")]))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
