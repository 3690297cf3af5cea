"""Secret scan by multipart credential linking.

Strong secrets are reported on their own: assignments of 12 or more characters
to a secret's name, access identifiers of 18 or more characters, hexadecimal
runs of 16 or more. Weak parts are reported only with what completes them, found
by an interval join within a scope (``scope`` code points either way):

* ``short`` (a secret's name with a value of 6 to 11 characters) and ``bare``
  (a lone 40-character base64 token) need an identifier or an endpoint;
* ``login`` (a user, client or key id assignment) needs a secret;
* ``endpoint`` (service URL or address with port) needs a secret and an
  identifier.

The parts of a text are arrays in its own row, so the interval join needs no
shuffle and does not depend on unique ids. It is an existence join that gives
each weak part at most once, by two sweeps over the parts in order of their starts: the greatest
end so far tells what is near to the left, the least start yet to come what is near to the right.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.spans import SPAN, by_start, joined, scan, spans

# The base patterns of the contract (possessive at the end, where it changes nothing).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"[0-9a-f]{16,}+"

LOGIN = (r"""(?i)(?<![A-Za-z0-9])(?:user(?:_?name)?|login|account|client_?id|access_?key_?id)["']?"""
         r"""\x20{0,9}[:=]\x20{0,9}["']?[A-Za-z0-9@._+-]{3,}+""")
BARE = r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
ENDPOINT = (r"""(?<![A-Za-z0-9])(?:https?|ftp|ssh|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]{3,}+"""
            r"|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}:[0-9]{2,5}(?![0-9])")


IDS, SECRETS = ("access", "login"), ("assign", "hex", "short", "bare")
_FAR = 2_000_000_000


def _linked(every: Column, scope: int) -> Column:
    """The weak parts of ``every``, spans by start, whose complementary parts lie within ``scope``."""
    seen = "array<struct<x:struct<s:int,e:int,kind:string,rank:int,m:string,score:double>,id:boolean,secret:boolean,end:boolean>>"
    none = F.array().cast(SPAN)

    def classes(x: Column) -> tuple[Column, Column, Column]:
        return x["kind"].isin(*IDS), x["kind"].isin(*SECRETS), x["kind"] == "endpoint"

    def carried(state: Column, x: Column, value: Column, better: Callable[[Column, Column], Column]) -> Column:
        return F.struct(*[F.when(own, better(state[n], value)).otherwise(state[n]).alias(n)
                          for n, own in zip(("id", "secret", "end"), classes(x), strict=True)])

    def state(value: int) -> Column:
        return F.struct(*[F.lit(value).alias(n) for n in ("id", "secret", "end")])

    def left(last: Column, x: Column) -> tuple[Column, Column]:
        near = [(last[n] > x["s"] - scope).alias(n) for n in ("id", "secret", "end")]
        return carried(last, x, x["e"], F.greatest), F.array(F.struct(x.alias("x"), *near)).cast(seen)

    def right(next_: Column, y: Column) -> tuple[Column, Column]:
        x = y["x"]
        near = {n: y[n] | (next_[n] < x["e"] + scope) for n in ("id", "secret", "end")}
        linked = ((x["kind"].isin("short", "bare") & (near["id"] | near["end"])) | ((x["kind"] == "login") & near["secret"])
                  | ((x["kind"] == "endpoint") & near["secret"] & near["id"]))
        return carried(next_, x, x["s"], F.least), F.when(linked, F.array(x)).otherwise(none)

    forward = scan(every, state(-_FAR), left, seen)
    return scan(F.reverse(forward), state(_FAR), right, SPAN)


def credential_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = 400) -> DataFrame:
    """One row per input row: ``doc_id``, ``base`` and ``parts`` (arrays of spans by start).

    ``base`` holds the strong secrets, ``parts`` these and the linked weak parts.
    A null or empty text has empty arrays, repeated rows each give a row, an empty table none; other columns are ignored.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    t = F.col("_t")
    value = lambda x: F.char_length(F.regexp_extract(x["m"], ASSIGN, 2))
    named = t.contains(":") | t.contains("=")
    out = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("_t")).select(
        "doc_id", "_t",
        spans(t, ASSIGN, "assign", 0, guard=named).alias("_named"),
        F.filter(spans(t, ACCESS, "access", 1, guard=t.contains("AKIA")), lambda x: F.char_length(x["m"]) >= 18).alias("_access"),
        spans(t, HEX, "hex", 2).alias("_hex"),
        spans(t, BARE, "bare", 4, 0.5).alias("_bare"),
        spans(t, LOGIN, "login", 5, 0.5, guard=named).alias("_login"),
        spans(t, ENDPOINT, "endpoint", 6, 0.5, guard=t.contains(":")).alias("_end"))
    short = F.transform(F.filter("_named", lambda x: value(x).between(6, 11)), lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"), F.lit("short").alias("kind"), F.lit(3).alias("rank"),
        x["m"].alias("m"), F.lit(0.5).alias("score")))
    out = out.select("doc_id", "_access", "_hex", "_bare", "_login", "_end",
                     F.filter("_named", lambda x: value(x) >= 12).alias("_assign"), short.alias("_short"))
    out = out.select("*", F.concat("_access", "_login").alias("_ids"),
                     F.concat("_assign", "_hex", "_short", "_bare").alias("_secrets"))
    weak = F.when(
        (F.size("_short") + F.size("_bare") + F.size("_login") + F.size("_end") > 0)
        & (F.size("_secrets") > 0) & (F.size("_ids") + F.size("_end") > 0),
        _linked(by_start(F.concat("_ids", "_secrets", "_end")), scope)).otherwise(F.slice("_short", 1, 0))
    base = F.concat("_assign", "_access", "_hex")
    return out.select("doc_id", by_start(base).alias("base"), by_start(F.concat(base, weak)).alias("parts"))


def credential_counts(docs: DataFrame, scope: int = 400) -> DataFrame:
    """Counts and digests of :func:`credential_spans`, one row per input row."""
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint")
    return credential_spans(docs, scope=scope).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("parts")).alias("spans"),
        (F.size("parts") - F.size("base")).cast("bigint").alias("n_linked"))
