"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans, checks confirm them (Luhn for cards, mod 97
for account numbers, ranges for addresses, digit counts for phones), and nearby
words raise or lower the score.  The four base kinds are reported whenever they
are confirmed; ``iban`` and ``national_id`` are added where their score reaches
``LEAST_SCORE``.

Where a text is split at a pattern, the parts and the matches alternate, so the
place of a match is the sum of the lengths before it; sums run in blocks and
stay linear in the number of matches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import column, table

BLOCK = 128  # matches summed in one block
NEARBY = 40  # code points before a match that are searched for context
LEAST_SCORE = 0.7

# The patterns are possessive, and anchored where a match may start, so that no
# text takes quadratic time; they match what the plain forms match.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Characters of an account number by country; a fixed table (registry of ISO 13616).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC",
    33: "RU"}
_KNOWN = "|".join(c for n in IBAN_LENGTHS.values() for c in n.split())
# other countries: any length the norm allows
IBAN = (r"(?<![A-Za-z0-9])(?:" + "|".join(
    rf"(?:{'|'.join(c.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
    + rf"|(?!{_KNOWN})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}})(?![A-Za-z0-9])")
NATIONAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

# Fixed words that make a kind likelier when they stand before a match.
WORDS = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": "ip|host|server|address|adresse|login",
    "card": "card|credit|visa|payment|karte|tarjeta|carte",
    "phone": "phone|tel|call|mobile|fax|telefon|llame|appel",
    "iban": "iban|account|bank|konto|cuenta|compte",
    "national_id": "ssn|social|security|national|ausweis|dni|identity",
}


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def worth(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = (F.length(digits) - i) % 2 == 1
        return F.when(twice, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account number (no blanks) leaves 1 when divided by 97."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 65, (rest * 10 + c - 48) % 97).otherwise((rest * 100 + c - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _small_number(part: Column) -> Column:
    plain = F.regexp_replace(part, "^0+", "")
    return (F.length(plain) < 3) | ((F.length(plain) == 3) & (plain <= "255"))


def _is_card(value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: Callable[[Column], Column]  # a cheap test that every text with a match passes
    confirmed: Callable[[Column], Column]
    base: bool = True
    score: float = 0.5  # before context words


KINDS = (
    Kind("email", EMAIL, lambda t: t.contains("@"), lambda v: F.lit(True), score=0.8),
    Kind("ip", IP, lambda t: t.rlike(r"[0-9]\.[0-9]"),
         lambda v: F.forall(F.split(v, r"\."), _small_number), score=0.6),
    Kind("card", CARD, lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"), _is_card, score=0.8),
    Kind("phone", PHONE, lambda t: t.contains("+"),
         lambda v: F.length(F.regexp_replace(v, "[^0-9]", "")).between(9, 15), score=0.6),
    Kind("iban", IBAN, lambda t: t.rlike("[A-Z]{2}[0-9]{2}"),
         lambda v: mod97(F.regexp_replace(v, r"\x20", "")), base=False, score=0.75),
    Kind("national_id", NATIONAL, lambda t: t.rlike("[0-9]-[0-9]{2}-[0-9]"),
         lambda v: ~F.substring(v, 1, 3).isin("000", "666"), base=False, score=0.5),
)


def _running(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace each array ``step_<name>`` by the sums before its elements, ``sum_<name>``."""
    def blocks(values: Column) -> Column:
        n = F.size(values)
        return F.when(n > 0, F.transform(
            F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")),
            lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK)),
        )).otherwise(F.array().cast("array<array<bigint>>"))

    def grow(first: Column, values: Column) -> Column:
        return F.aggregate(values, F.array(first),
                           lambda a, x: F.array_append(a, F.element_at(a, -1) + x))

    df = df.withColumns({f"block_{k}": blocks(F.col(f"step_{k}")) for k in names})
    df = df.withColumns({f"first_{k}": grow(F.lit(0).cast("bigint"), F.transform(
        F.col(f"block_{k}"), lambda b: F.aggregate(b, F.lit(0).cast("bigint"), lambda a, x: a + x))
    ) for k in names})
    return df.withColumns({f"sum_{k}": F.flatten(F.zip_with(
        F.col(f"block_{k}"), F.slice(f"first_{k}", F.lit(1), F.size(f"block_{k}")),
        lambda b, first: F.slice(grow(first, b), F.lit(1), F.size(b)),
    )) for k in names})


def find_personal_data(docs: DataFrame, kinds: Sequence[Kind] = KINDS) -> DataFrame:
    """doc_id, text and ``found``: an array of (start, place, end, kind, base, score) per row.

    Starts and ends count code points; ``place`` is the kind's place in ``kinds``.
    A NULL text counts as empty and has no span.  Each row of ``docs`` gives one
    row, repeated or not; other columns are ignored, an empty table gives none.
    """
    names = [k.name for k in kinds]
    no_strings = F.array().cast("array<string>")
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    df = docs.select(column(docs, "doc_id", "long").alias("doc_id"), text.alias("text"))
    df = df.withColumns({f"hint_{k.name}": k.hint(F.col("text")) for k in kinds})
    df = df.withColumns({f"hit_{k.name}": F.when(
        F.col(f"hint_{k.name}"), F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0))
    ).otherwise(no_strings) for k in kinds})
    df = df.withColumns({f"part_{k.name}": F.when(
        F.size(f"hit_{k.name}") > 0, F.split("text", k.pattern, -1)
    ).otherwise(no_strings) for k in kinds})
    df = df.withColumns({f"pair_{n}": F.zip_with(
        F.col(f"hit_{n}"), F.slice(f"part_{n}", F.lit(1), F.size(f"hit_{n}")),
        lambda hit, part: F.struct(
            F.length(part).cast("bigint").alias("gap"), F.length(hit).cast("bigint").alias("size"),
            hit.alias("value"), F.lower(F.right(part, F.lit(NEARBY))).alias("before")),
    ) for n in names})
    df = df.withColumns({f"step_{n}": F.transform(f"pair_{n}", lambda p: p["gap"] + p["size"])
                         for n in names})
    df = _running(df, names)

    def located(k: Kind, place: int) -> Column:
        near = rf"\b(?:{WORDS[k.name]})"

        def span(p: Column, before: Column) -> Column:
            start = before + p["gap"]
            return F.struct(
                start.alias("start"), F.lit(place).alias("place"),
                (start + p["size"]).alias("end"), F.lit(k.name).alias("kind"),
                F.lit(k.base).alias("base"),
                F.round(F.lit(k.score) + F.when(p["before"].rlike(near), 0.2).otherwise(0.0), 2)
                .alias("score"),
                p["value"].alias("value"))

        both = F.zip_with(f"pair_{k.name}", f"sum_{k.name}", span)
        good = F.filter(both, lambda s: k.confirmed(s["value"]))
        return good if k.base else F.filter(good, lambda s: s["score"] >= LEAST_SCORE)

    return df.select("doc_id", "text", F.sort_array(F.concat(
        *[located(k, place) for place, k in enumerate(kinds)])).alias("found"))


def spans_text(found: Column) -> Column:
    return F.array_join(F.transform(
        found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                     s["end"].cast("string"))), ",")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of whole texts, one row per row of ``documents``."""
    found = find_personal_data(table(spark, sf_dir, "documents"))

    def number(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("found", lambda s: s["base"])
    return found.select(
        "doc_id", *[number(k.name).alias(f"n_{k.name}") for k in KINDS if k.base],
        F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("found")).alias("spans"),
        *[number(k.name).alias(f"n_{k.name}") for k in KINDS if not k.base],
        F.round(F.aggregate("found", F.lit(0.0), lambda a, s: F.greatest(a, s["score"])), 2)
        .alias("top_score"),
    )
