"""Personal-data scan: patterns propose, checksums confirm, context adjusts.

Regular expressions propose spans of e-mail and IP addresses, payment cards,
phone numbers and IBANs; a span is confirmed by its own rule (octets up to 255,
Luhn, digit count, mod-97), and words near it raise or lower its score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.spans import SPAN, joined, let, part, pieces, scan, spans

# The base patterns of the contract. Possessive loops and the
# look-behinds keep them linear and free of recursion on long runs; the
# matches are the same (tested against the plain patterns).
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Lengths of IBANs by country, those of the registry and those in use beside it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}
IBAN = "(?:" + "|".join(
    rf"(?:{'|'.join(names.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])" for n, names in IBAN_LENGTHS.items()) + ")"
# Only the country and check digits are consumed, so a false start hides no IBAN that begins in it.
IBAN_START = rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?={IBAN})[A-Z]{{2}}[0-9]{{2}}"

OCTET = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})$"

# Words near a span that support its kind, and words that speak against any.
SUPPORT = {
    "email": r"\b(?:e-?mail|contact|write|correo|courriel|kontakt)\b",
    "ip": r"\b(?:ip|host|server|address|client|adresse)\b",
    "card": r"\b(?:card|visa|mastercard|credit|karte|tarjeta|carte)\b",
    "phone": r"\b(?:tel|telephone|phone|call|mobile|fax|telefon|teléfono|téléphone)\b",
    "iban": r"\b(?:iban|account|bank|konto|cuenta|compte)\b",
}
AGAINST = r"\b(?:version|release|order|invoice|isbn|serial|example|sample)\b"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """The digits of ``text`` pass the Luhn check."""
    back = F.reverse(digits(text))

    def weight(i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.sequence(F.lit(1), F.char_length(back)), F.lit(0), lambda acc, i: acc + weight(i))
    return total % 10 == 0


def mod97(text: Column) -> Column:
    """``text`` passes the ISO 7064 mod-97 check of an IBAN."""
    plain = F.regexp_replace(text, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.char_length(plain)), F.substring(plain, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    rest = F.aggregate(F.sequence(F.lit(1), F.char_length(turned)), F.lit(0), step)
    return rest == 1


def _ibans(text: Column) -> Column:
    """The confirmed IBANs; of two that overlap the first."""
    begun = spans(text, IBAN_START, "iban", 4)

    def confirmed(every: Column, cut: Column) -> Column:
        def whole(x: Column) -> Column:
            m = F.regexp_extract(part(cut, x["s"], 2 * max(IBAN_LENGTHS)), f"^{IBAN}", 0)
            return F.struct(x["s"].alias("s"), (x["s"] + F.char_length(m)).alias("e"), x["kind"].alias("kind"), x["rank"].alias("rank"),
                            m.alias("m"), x["score"].alias("score"))
        return F.filter(F.transform(every, whole).cast(SPAN), lambda x: mod97(x["m"]))

    def step(last: Column, x: Column) -> tuple[Column, Column]:
        free = last <= x["s"]
        return F.when(free, x["e"]).otherwise(last), F.when(free, F.array(x)).otherwise(F.array().cast(SPAN))

    none = F.array().cast(SPAN)
    return let(begun, lambda every: F.when(F.size(every) == 0, none).otherwise(
        let(pieces(text), lambda cut: scan(confirmed(every, cut), F.lit(0), step, SPAN))))


def _octets(text: Column) -> Column:
    return F.forall(F.split(text, r"\."), lambda part: part.rlike(OCTET))


def _ranked(text: Column, found: Column, reach: int) -> Column:
    """Spans with their score: 0.7 for a confirmed span, +0.2 or -0.3 by the words near it."""
    def near(cut: Column, x: Column) -> Column:
        first = F.greatest(x["s"] - reach, F.lit(0))
        return F.lower(F.concat_ws(" ", part(cut, first, x["s"] - first), part(cut, x["e"], reach)))

    def scored(cut: Column, x: Column) -> Column:
        words = near(cut, x)
        support = F.lit(False)
        for kind, pattern in SUPPORT.items():
            support = support | ((x["kind"] == kind) & words.rlike(pattern))
        score = F.lit(0.7) + F.when(support, 0.2).otherwise(0.0) - F.when(words.rlike(AGAINST), 0.3).otherwise(0.0)
        return F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"), x["rank"].alias("rank"),
                        x["m"].alias("m"), F.round(score, 2).alias("score"))
    ranked = let(pieces(text), lambda cut: F.transform(found, lambda x: scored(cut, x)))
    return F.when(F.size(found) > 0, ranked).otherwise(F.array()).cast(SPAN)


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 40) -> DataFrame:
    """One row per input row: ``doc_id`` and ``found``, spans by kind, then start.

    Kinds: email, ip, card, phone (the base), iban. Each span has its text and
    score. A null or empty text has none, repeated rows each give a row, an empty table none; other columns are ignored.
    """
    t = F.col("_t")
    size = lambda x: F.char_length(digits(x["m"]))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    out = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("_t")).select(
        "doc_id", "_t",
        spans(t, EMAIL, "email", 0, guard=t.contains("@")).alias("_email"),
        F.filter(spans(t, IP, "ip", 1), lambda x: _octets(x["m"])).alias("_ip"),
        F.filter(spans(t, CARD, "card", 2), lambda x: size(x).between(16, 19) & luhn(x["m"])).alias("_card"),
        F.filter(spans(t, PHONE, "phone", 3, guard=t.contains("+")), lambda x: size(x).between(8, 15)).alias("_phone"),
        _ibans(t).alias("_iban"))
    out = out.select("doc_id", "_t", F.concat("_email", "_ip", "_card", "_phone", "_iban").alias("_found"))
    return out.select("doc_id", _ranked(t, F.col("_found"), reach).alias("found"))


def personal_counts(docs: DataFrame) -> DataFrame:
    """Counts and digests of :func:`personal_spans`, one row per input row."""
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("bigint")
    base = F.filter("found", lambda x: x["rank"] < 4)
    return personal_spans(docs).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"),
        count("iban").alias("n_iban"),
        F.array_join(F.transform("found", lambda x: x["score"].cast("string")), ",").alias("scores"))
