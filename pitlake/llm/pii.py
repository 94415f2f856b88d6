"""PII: regular expressions propose spans, checksums confirm them, nearby
context words adjust the score.  Built-in functions only.

Positions come from one pass: ``split`` gives the pieces between the
matches that ``regexp_extract_all`` gives, and running sums of their lengths,
in blocks and each made once, give starts and ends in code points.  The time
grows with the length of a text and the number of its matches.  The patterns are written so that no
text makes them backtrack over a whole run from each of its positions; they
match exactly what their plain forms (in the comments) match.

Kinds: email, ip (parts at most 255), card (16 to 19 digits passing Luhn),
phone (8 to 15 digits); these base spans always stay.  Added spans: iban
(mod-97 confirmed) and id (three-two-four digits), which need a score of
ADD_AT.  A span's score is its kind's prior, raised by CONTEXT_GAIN when a
context word of its kind stands in the CONTEXT code points before it.

Defined cases: a null or empty text has no spans; a very long text is read
whole, and so is one of very many matches; of matches that overlap within a
kind the leftmost stays, kinds do not hide each other; repeated rows are scored
one by one; a null id is carried through; an empty table gives no rows; extra
columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: fixed values: span patterns
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"  # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"                                                      # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
CARD = r"[0-9](?:[ -]?[0-9])++"                                                                # [0-9]([\x20-]?[0-9])+
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
ID = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

#: fixed values: kind -> (pattern, character every match contains, prior score, context words)
KINDS = {
    "email": (EMAIL, "@", 0.9, "mail|contact|write"),
    "ip": (IP, ".", 0.6, "ip|host|server|address"),
    "card": (CARD, None, 0.9, "card|visa|credit|pay"),
    "phone": (PHONE, "+", 0.6, "phone|tel|call|mobile|fax"),
    "iban": (IBAN, None, 0.9, "iban|account|bank|konto|compte|cuenta"),
    "id": (ID, "-", 0.3, "ssn|social|security|tax"),
}
BASE = ("email", "ip", "card", "phone")
CONTEXT, CONTEXT_GAIN, ADD_AT = 40, 0.35, 0.6
#: lengths are summed in blocks of so many matches; matches, of two code points at least, that reach over the context
BLOCK, REACH = 256, CONTEXT // 2

_append = lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` made once, however often it is used: it is the one element of an array."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _before(lengths: Column) -> Column:
    """Running sums of ``lengths``, each without its own: linear in blocks."""
    blocks = lambda v: F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
    part = lambda v, b: F.slice(v, b * BLOCK + 1, F.lit(BLOCK))
    total = lambda v: F.aggregate(F.transform(blocks(v), lambda b: F.aggregate(part(v, b), F.lit(0), lambda a, x: a + x)),
                                  F.array(F.lit(0)), _append)
    inside = lambda v, starts: F.flatten(F.transform(blocks(v), lambda b: F.slice(
        F.aggregate(part(v, b), F.array(F.element_at(starts, b + 1)), _append), 1, F.size(part(v, b)))))
    sums = lambda v: F.when(F.size(v) > 0, _once(total(v), lambda starts: inside(v, starts))).otherwise(F.array().cast("array<int>"))
    return _once(lengths, sums)


def _tails(m: Column, p: Column) -> Column:
    """The last CONTEXT code points of each piece and the match after it."""
    last = lambda s: F.right(s, F.lit(CONTEXT))
    return F.zip_with(m, F.slice(p, F.lit(1), F.size(m)), lambda a, b: last(F.concat(last(b), last(a))))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn's checksum over a string of digits."""
    n = F.length(digits)
    at = lambda i: F.substring(digits, i, F.lit(1)).cast("int")
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + F.when((n - i) % 2 == 1, doubled(at(i))).otherwise(at(i)))
    return total % 10 == 0


def mod97(s: Column) -> Column:
    """The mod-97 checksum of an account number: letters count as 10 to 35."""
    flat = F.replace(s, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(flat, F.lit(5), F.length(flat)), F.substring(flat, F.lit(1), F.lit(4)))
    value = lambda c: F.ascii(c) - F.when(F.ascii(c) >= 65, 55).otherwise(48)
    total = F.aggregate(F.split(turned, ""), F.lit(0),
                        lambda a, c: F.when(c == "", a).otherwise((a * F.when(F.ascii(c) >= 65, 100).otherwise(10) + value(c)) % 97))
    return total == 1


def _valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        plain = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(s, r"\."), lambda p: (F.length(plain(p)) <= 3) & (F.coalesce(F.substring(plain(p), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(F.length(_digits(s)).between(16, 19), luhn(_digits(s))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(s)).between(8, 15)
    if kind == "iban":
        return mod97(s)
    return F.lit(True)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and ``spans``, an array of (kind, start,
    end, score, value) by kind as in KINDS, then start; end exclusive."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.col(id_col).alias("__id"), text.alias("__t"))
    none = F.array().cast("array<string>")
    cut = []
    for kind, (pattern, needs, _, _) in KINDS.items():
        found, pieces = F.regexp_extract_all("__t", F.lit(pattern), F.lit(0)), F.split("__t", pattern, -1)
        may = F.contains("__t", F.lit(needs)) if needs else F.col("__t").rlike("[0-9]")
        cut += [F.when(may, found).otherwise(none).alias(f"m_{kind}"), F.when(may, pieces).otherwise(none).alias(f"p_{kind}")]
    df = df.select("__id", *cut)
    length = lambda m, p: F.zip_with(m, F.slice(p, F.lit(1), F.size(m)), lambda a, b: F.length(a) + F.length(b))
    df = df.select("*", *(_before(length(F.col(f"m_{k}"), F.col(f"p_{k}"))).alias(f"b_{k}") for k in KINDS))
    spans = []
    for kind, (_, _, prior, words) in KINDS.items():
        m, p, b = F.col(f"m_{kind}"), F.col(f"p_{kind}"), F.col(f"b_{kind}")
        before = lambda t, x: F.concat(F.array_join(F.slice(t, F.greatest(x["i"] - REACH + 1, F.lit(1)), F.least(x["i"], F.lit(REACH))), ""),
                                       F.right(x["p"], F.lit(CONTEXT)))
        near = lambda t, x: F.lower(F.right(before(t, x), F.lit(CONTEXT))).rlike(f"(?<![a-z])(?:{words})")  # noqa: E731,B023
        score = lambda t, x: F.least(F.lit(1.0), F.lit(prior) + F.when(near(t, x), CONTEXT_GAIN).otherwise(0.0))  # noqa: E731,B023
        zipped = F.arrays_zip(m.alias("m"), F.slice(p, F.lit(1), F.size(m)).alias("p"), b.alias("b"), F.transform(m, lambda _, i: i).alias("i"))
        valid = F.filter(zipped, lambda x: _valid(kind, x["m"]))  # noqa: B023
        # both arrays are made once: they are the one element's fields
        once = F.array(F.struct(_tails(m, p).alias("t"), valid.alias("v")))
        made = F.flatten(F.transform(once, lambda s: F.transform(s["v"], lambda x: F.struct(
            F.lit(kind).alias("kind"), (x["b"] + F.length(x["p"])).alias("start"),  # noqa: B023
            (x["b"] + F.length(x["p"]) + F.length(x["m"])).alias("end"), score(s["t"], x).alias("score"), x["m"].alias("value")))))  # noqa: B023
        spans.append(made if kind in BASE else F.filter(made, lambda s: s["score"] >= ADD_AT))
    return df.select(F.col("__id").alias(id_col), F.concat(*spans).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    found = find_pii(docs)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in BASE), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"), F.to_json(F.transform("spans", lambda s: F.round(s["score"], 2))).alias("scores"))
