"""Personal data: patterns propose spans, checksums confirm, nearby words adjust a score.

DataFrame functions only. A pattern's matches and the pieces of text between them
alternate, so a match's place is the sum of the lengths before it: one shuffle of the
matches by row, without the texts, gives places, checks and the spans of each row.
Patterns are written so that matching is linear in the length of the text (possessive
repeats, and no second start within a run that has failed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The patterns of the base kinds, in the order of their listing.
# (?:\G|(?<!...)) starts a match where a run starts or where the last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{20,}+",
}
BASE = ("email", "ip", "card", "phone")

#: What a text must hold for a pattern to be tried; cheaper than the pattern.
_HINTS = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]"),
    "ssn": lambda t: t.rlike(r"[0-9]-[0-9]{2}-[0-9]"),
    "secret": lambda t: t.rlike(r"[A-Za-z0-9_/+-]{20}"),
}

#: Words that, within ``NEARBY`` characters, raise the score of a kind.
CONTEXT = {
    "email": "mail|contact|write|courriel|correo",
    "ip": "ip|address|host|server|adresse",
    "card": "card|visa|credit|karte|carte|tarjeta",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social security|social",
    "secret": "key|apikey|api_key|token|secret|password|passwd|bearer|credential|credentials",
}
NEARBY = 40
SCORE = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.4, "secret": 0.4}
CONTEXT_BONUS = 0.2

#: Score from which a span of an added kind counts; base kinds always do.
ACCEPT = 0.5

_SPAN = "array<struct<start:bigint,order:int,kind:string,end:bigint,value:string,score:double>>"


def _proposed(text: str, kind: str) -> Column:
    """Matches with the length of the piece before each and the words around it."""
    matches, pieces = F.col(f"{kind}_m"), F.col(f"{kind}_p")
    order = list(PATTERNS).index(kind)
    return F.transform(
        matches,
        lambda v, i: F.struct(
            F.lit(order).alias("order"),
            F.lit(kind).alias("kind"),
            i.alias("pos"),
            F.length(F.get(pieces, i)).cast("bigint").alias("gap"),
            v.alias("value"),
            F.concat_ws(
                " ",
                F.substring(F.get(pieces, i), -NEARBY, NEARBY),
                F.substring(F.get(pieces, i + 1), 1, NEARBY),
            ).alias("around"),
        ),
    )


def luhn(digits: Column) -> Column:
    """Whether a string of decimal digits passes the Luhn check."""

    def add(total, i):
        digit = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number without spaces passes the ISO 7064 check of IBANs."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def add(rest, c):
        value = F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.split(turned, "(?<=.)(?=.)"), F.lit(0), add) == 1


def _valid(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    small = F.forall(
        F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")
    )
    count = F.length(digits)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", small)
        .when(kind == "card", F.when(count.between(12, 19), luhn(digits)).otherwise(False))
        .when(kind == "phone", count.between(9, 15))
        .when(kind == "iban", mod97(F.regexp_replace(value, " ", "")))
        # Area, group and serial numbers that are never issued.
        .when(kind == "ssn", ~value.rlike("^(?:000|666|9)|-00-|-0000$"))
        .when(kind == "secret", value.rlike("[0-9]") & value.rlike("[A-Za-z]"))
    )


def _score(kind: Column, around: Column) -> Column:
    score = F.lit(0.0)
    for name, base in SCORE.items():
        near = around.rlike(rf"(?i)\b(?:{CONTEXT[name]})\b")
        score = F.when(kind == name, F.when(near, min(1.0, base + CONTEXT_BONUS)).otherwise(base)).otherwise(score)
    return score


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """One row per row of ``docs``: its id and ``spans``, an array sorted by start and kind.

    A span has ``start``, ``order`` (of its kind), ``kind``, ``end`` (code points, end
    exclusive), ``value`` and ``score`` (0 to 1; higher where a word of the kind's
    context is near). Spans of the kinds beyond the base ones count from a score of
    ``accept`` on: an account number by its checksum alone, a social security number or a
    key only with a word of its context within ``NEARBY`` characters. Per kind, matches are leftmost and do not overlap; those that
    fail their check are dropped and not tried again. Spans of different kinds may
    overlap. A null or empty text has no spans. Repeated rows and null ids come out as
    often as they went in, other columns are not read, and no rows give no rows.
    """
    text = F.col("text")
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    rows = rows.select(
        "*",
        *(
            F.when(_HINTS[k](text), F.regexp_extract_all(text, F.lit(p), F.lit(0))).alias(f"{k}_m")
            for k, p in PATTERNS.items()
        ),
    )
    rows = rows.select(
        "*", *(F.when(F.size(f"{k}_m") > 0, F.split(text, p, -1)).alias(f"{k}_p") for k, p in PATTERNS.items())
    )
    proposed = F.flatten(F.array_compact(F.array(*(_proposed("text", k) for k in PATTERNS))))
    found = rows.select("id", "row", F.explode_outer(proposed).alias("x")).select("id", "row", "x.*")
    # Rows without a match go along, so nothing has to be joined back.
    found = found.repartition("row")
    before = Window.partitionBy("row", "order").orderBy("pos")
    placed = found.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(before))
    kind, value = F.col("kind"), F.col("value")
    score = _score(kind, F.col("around"))
    span = F.struct(
        (F.col("end") - F.length(value)).alias("start"),
        F.col("order"),
        kind,
        F.col("end"),
        value,
        score.alias("score"),
    )
    counts = _valid(kind, value) & (kind.isin(*BASE) | (score >= accept))
    return (
        placed.groupBy("row")
        .agg(
            F.first("id").alias("id"),
            F.array_sort(F.collect_list(F.when(counts, span))).cast(_SPAN).alias("spans"),
        )
        .select(F.col("id").alias(id_col), "spans")
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id and ``redacted``: the text with each span's characters as its kind in brackets.

    Of overlapping spans the first one counts. Spans follow from the text, so they are
    found once for each distinct text and joined by its digest: repeated ids and rows and
    null ids come out as they went in. A null text stays null, an empty one empty; other
    columns are not read, and no rows give no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    spans = find_spans(rows.dropDuplicates(["digest"]), "digest", "text")
    text = F.col("text")

    def step(done, s):
        fits = s["start"] >= done["at"]
        added = F.concat(
            done["out"],
            F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int")),
            F.lit("["),
            s["kind"],
            F.lit("]"),
        )
        return F.struct(
            F.when(fits, added).otherwise(done["out"]).alias("out"),
            F.when(fits, s["end"]).otherwise(done["at"]).alias("at"),
        )

    empty = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    rest = lambda d: F.concat(d["out"], F.substring(text, (d["at"] + 1).cast("int"), F.length(text)))
    return rows.join(spans, "digest").select(
        F.col("id").alias(id_col), F.aggregate("spans", empty, step, rest).alias("redacted")
    )
