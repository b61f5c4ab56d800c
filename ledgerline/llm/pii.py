"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust scores.

Built-in functions only, one projection, no shuffle. Spans are code-point ranges (start, end exclusive),
leftmost and non-overlapping per kind. Nulls count as empty texts and have no spans; rows are handled one
by one, so ties, repeated rows, empty tables and other columns need no rule.

Patterns only start where a run of their first characters starts or where the last match ended (``\\G``),
and repeat without backtracking. That finds what a plain scan finds, in linear time on very long words.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _all(match: Column) -> Column:
    return F.lit(True)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _octets(match: Column) -> Column:
    """Four parts of at most 255, leading zeros allowed."""
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    return match.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _luhn(match: Column) -> Column:
    """13 to 19 digits whose doubled alternate digits sum to a multiple of ten."""
    digits = F.reverse(_digits(match))

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).otherwise(
            F.when(twice > 9, twice - 9).otherwise(twice)
        )

    size = F.length(digits)
    total = F.aggregate(F.sequence(F.lit(1), F.least(size, F.lit(19))), F.lit(0), add)
    return F.when(size.between(13, 19), total % 10 == 0).otherwise(F.lit(False))


def _dialable(match: Column) -> Column:
    return F.length(_digits(match)).between(9, 15)


def _mod97(match: Column) -> Column:
    """Bank account numbers: first four characters last, letters as 10 to 35, remainder 1 modulo 97."""
    plain = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code <= 57, (rest * 10 + code - 48) % 97).otherwise(
            (rest * 100 + code - 55) % 97
        )

    rest = F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step)
    return F.when(F.length(plain).between(15, 34), rest == 1).otherwise(F.lit(False))


class Kind(NamedTuple):
    """``score`` of a confirmed match, raised by ``boost`` when a context word stands close before it.

    A base kind is reported whatever its score; another only from ``REPORT`` on.
    """

    name: str
    pattern: str
    confirmed: Callable[[Column], Column]
    score: float
    boost: float
    context: str
    base: bool


REPORT = 0.5
NEAR = 40  # code points before a match that may hold a context word

_LOCAL = "[A-Za-z0-9._%+-]"
KINDS = (
    Kind(
        "email",
        rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        _all, 0.9, 0.1, r"mail|contact|kontakt|correo|courriel", True,
    ),
    Kind(
        "ip",
        r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        _octets, 0.6, 0.3, r"\bip\b|address|server|host|adresse|direcci", True,
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        _luhn, 0.8, 0.2, r"card|visa|credit|karte|carte|tarjeta", True,
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        _dialable, 0.7, 0.3, r"phone|tel|call|mobil|anruf|appel|llam", True,
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        _mod97, 0.9, 0.1, r"iban|account|konto|compte|cuenta|bank", False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9[0-9]{2})[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        _all, 0.3, 0.5, r"\bssn\b|social security|tax id", False,
    ),
    Kind(
        "key",
        r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|[0-9a-f]{40}|[0-9a-f]{18})(?![A-Za-z0-9])",
        lambda m: m.startswith("AKIA") | (m.rlike("[0-9]") & m.rlike("[a-f]")),
        0.3, 0.5, r"key|token|password|passwd|secret|akia", False,
    ),
)


def _total(part: Column) -> Column:
    return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)


def running_sums(lengths: Column, block: int = 256) -> Column:
    """Sums of all earlier entries, by sums of blocks, so that long arrays don't cost their square."""
    n = F.size(lengths)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int")),
        lambda b: _total(F.slice(lengths, b * block + 1, F.lit(block))),
    )
    return F.when(
        n > 0,
        F.transform(
            lengths,
            lambda _, k: _total(F.slice(blocks, F.lit(1), F.floor(k / block).cast("int")))
            + _total(F.slice(lengths, F.floor(k / block).cast("int") * block + 1, k % block)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def proposals(text: Column, kind: Kind) -> Column:
    """Confirmed matches as array<struct<kind, start, end, score>>.

    A match starts where all pieces between matches so far and all earlier matches end.
    """
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))

    def spans(matches: Column, pieces: Column) -> Column:
        strides = F.transform(
            matches, lambda m, k: (F.length(m) + F.length(F.get(pieces, k))).cast("long")
        )

        def build(before: Column) -> Column:
            return F.filter(
                F.transform(
                    matches,
                    lambda m, k: F.when(
                        kind.confirmed(m),
                        F.struct(
                            F.lit(kind.name).alias("kind"),
                            (F.get(before, k) + F.length(F.get(pieces, k))).alias("start"),
                            (F.get(before, k) + F.length(F.get(pieces, k)) + F.length(m)).alias("end"),
                            F.round(
                                F.lit(kind.score)
                                + F.when(
                                    F.lower(
                                        F.concat(F.right(F.get(pieces, k), F.lit(NEAR)),
                                                 F.lit("") if kind.base else F.left(m, F.lit(4)))
                                    ).rlike(kind.context),
                                    F.lit(kind.boost),
                                ).otherwise(0.0),
                                2,
                            ).alias("score"),
                        ),
                    ),
                ),
                lambda s: s.isNotNull() if kind.base else (s["score"] >= REPORT),
            )

        return F.transform(F.array(running_sums(strides)), build)[0]

    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    return F.when(
        F.size(found) > 0,
        F.transform(
            F.array(F.struct(found.alias("m"), F.split(text, kind.pattern, -1).alias("p"))),
            lambda both: spans(both["m"], both["p"]),
        )[0],
    ).otherwise(none)


def find_pii(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Add ``pii``: all spans by kind as listed, then by start."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.withColumn("pii", reduce(lambda a, b: F.concat(a, b), [proposals(body, k) for k in kinds]))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace every span by its kind in angle brackets; the first of overlapping spans wins."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    spans = F.array_sort(
        F.transform("pii", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    walked = F.aggregate(
        spans,
        state,
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                F.concat(
                    a["out"], F.substr(body, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                    F.lit("<"), s["kind"], F.lit(">"),
                ).alias("out"),
                s["end"].alias("at"),
            ),
        ).otherwise(a),
        lambda a: F.concat(a["out"], F.substr(body, (a["at"] + 1).cast("int"))),
    )
    return find_pii(docs, text).withColumn("redacted", walked)


BASE = [k.name for k in KINDS if k.base]


def _is_kind(name: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == name


def report(docs: DataFrame) -> DataFrame:
    """Digest columns of ``documents``: counts by base kind, digest of base spans, all spans."""
    found = find_pii(docs.select("doc_id", "text")).select("doc_id", "pii")
    base = F.filter("pii", lambda s: s["kind"].isin(BASE))
    return found.select(
        "doc_id",
        *[
            F.size(F.filter("pii", _is_kind(k))).cast("long").alias(f"n_{k}") for k in BASE
        ],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("pii")).alias("spans"),
    )
