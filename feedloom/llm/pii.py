"""Find personal data by patterns, checksums and nearby words, in SQL functions only.

A pattern proposes spans, leftmost and without overlap for each kind. A validator
confirms them: parts of an address up to 255, Luhn's sum for cards, the number of
digits of a phone, remainder 1 modulo 97 for account numbers (IBAN). A proposal that
fails is dropped and not tried again. Words around a span raise or lower its
score in percent. Spans of the base kinds stay whatever their score; those of
other kinds need ``least``.

Spark's patterns report no positions. A text is therefore split at the matches as
well, and the lengths of pieces and matches are added up; both are in code points.

Defined cases: a NULL text has no spans, as an empty one; equal rows get equal
results; an empty table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lengths are added up in slices of so many matches, so that work stays linear in practice.
_SLICE = 256


@dataclass(frozen=True)
class Kind:
    """One kind of personal data.

    ``pattern`` is possessive and looks back where its plain form would scan a long
    run again from each of its characters; it matches the same spans. ``hint`` says in
    which texts to look at all. ``valid`` is SQL over the match ``m``.
    """

    name: str
    pattern: str
    hint: str
    valid: str
    score: int
    base: bool
    nearby: tuple[str, ...] = ()
    against: tuple[str, ...] = ()


def _digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def _luhn(digits: str) -> str:
    """Sum of digits, every second one from the right doubled and reduced by 9."""
    digit = f"cast(substring({digits}, length({digits}) - i, 1) as int)"
    doubled = f"if({digit} > 4, 2 * {digit} - 9, 2 * {digit})"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (s, i) -> s + if(i % 2 = 1, {doubled}, {digit})) % 10 = 0"


def _mod97(m: str) -> str:
    """The first four characters go to the end, a letter counts as two digits."""
    plain = f"replace({m}, ' ', '')"
    turned = f"concat(substring({plain}, 5), substring({plain}, 1, 4))"
    step = "if(c between '0' and '9', (s * 10 + cast(c as int)) % 97, (s * 100 + ascii(c) - 55) % 97)"
    return f"aggregate(split({turned}, ''), 0, (s, c) -> if(c = '', s, {step})) = 1"


KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "contains(<text>, '@')",
        "true",
        85,
        True,
        ("mail", "email", "contact", "write"),
        ("example", "noreply"),
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
        r"<text> rlike '[0-9]\\.[0-9]'",
        r"m rlike '^(0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\\.|$)){4}$'",
        60,
        True,
        ("ip", "host", "server", "address", "client"),
        ("version", "release", "section"),
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        "<text> rlike '[0-9][0-9 -]{12}'",
        "length(<digits>) between 14 and 19 and " + _luhn("<digits>"),
        70,
        True,
        ("card", "visa", "credit", "payment", "paid"),
        ("order", "invoice", "isbn", "serial"),
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "contains(<text>, '+')",
        "length(<digits>) between 10 and 15",
        65,
        True,
        ("phone", "call", "tel", "mobile", "fax"),
        ("score", "sum"),
    ),
    Kind(
        "iban",
        r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
        "<text> rlike '[A-Z]{2}[0-9]{2}'",
        "length(replace(m, ' ', '')) between 15 and 34 and " + _mod97("m"),
        70,
        False,
        ("iban", "account", "bank", "konto", "transfer"),
        ("serial", "part", "order", "licence"),
    ),
)

#: Characters before and after a span that are searched for words.
BEFORE, AFTER = 48, 24


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _running(lengths: str) -> str:
    """Running sums of an array, slice by slice."""
    grow = "concat(a, array(element_at(a, -1) + v))"
    slices = f"transform(sequence(0, (size({lengths}) - 1) div {_SLICE}), k -> slice({lengths}, k * {_SLICE} + 1, {_SLICE}))"
    totals = f"transform({slices}, x -> aggregate(x, 0, (s, v) -> s + v))"
    starts = f"aggregate({totals}, array(0), (a, v) -> {grow})"
    inside = f"slice(aggregate(x, array(0), (a, v) -> {grow}), 2, size(x))"
    parts = f"zip_with({slices}, slice({starts}, 1, size({starts}) - 1), (x, o) -> transform({inside}, y -> y + o))"
    return f"flatten({parts})"


def _near(words: tuple[str, ...], around: str) -> str:
    """Whether one of the words stands in the lower-case text around."""
    return f"{around} rlike '(^|[^a-z])({'|'.join(words)})([^a-z]|$)'"


def spans(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS, least: int = 50) -> DataFrame:
    """``docs`` and ``_pii``: an array of ``start, rank, kind, stop, base, score``, by start and kind.

    ``start`` counts code points, ``stop`` is exclusive.
    """
    df = docs.withColumn("_pii_text", F.coalesce(F.col(text), F.lit("")))
    none = "cast(array() as array<string>)"
    for kind in kinds:
        pattern, name = _literal(kind.pattern), kind.name
        hint = kind.hint.replace("<text>", "_pii_text")
        df = df.withColumn(f"_pii_m_{name}", F.expr(f"if({hint}, regexp_extract_all(_pii_text, {pattern}, 0), {none})"))
    for kind in kinds:
        pattern, found = _literal(kind.pattern), f"_pii_m_{kind.name}"
        pieces = f"if(size({found}) > 0, split(_pii_text, {pattern}, -1), {none})"
        df = df.withColumn(
            f"_pii_l_{kind.name}",
            F.expr(f"zip_with(slice({pieces}, 1, size({found})), {found}, (p, m) -> length(p) + length(m))"),
        )
    for kind in kinds:
        lengths = f"_pii_l_{kind.name}"
        empty = "cast(array() as array<int>)"
        df = df.withColumn(f"_pii_e_{kind.name}", F.expr(f"if(size({lengths}) > 0, {_running(lengths)}, {empty})"))
    arrays = []
    for rank, kind in enumerate(kinds):
        valid = kind.valid.replace("<digits>", _digits("m"))
        proposed = f"zip_with(_pii_m_{kind.name}, _pii_e_{kind.name}, (m, e) -> struct(m, e))"
        confirmed = f"filter({proposed}, q -> {_with(valid, 'q.m')})"
        start = "(q.e - length(q.m))"
        around = (
            f"lower(concat(substring(_pii_text, greatest({start} - {BEFORE}, 0) + 1, least({start}, {BEFORE})),"
            f" ' ', substring(_pii_text, q.e + 1, {AFTER})))"
        )
        score = (
            f"least(100, greatest(0, {kind.score} + if({_near(kind.nearby, around)}, 25, 0)"
            f" - if({_near(kind.against, around)}, 25, 0)))"
        )
        made = (
            f"transform({confirmed}, q -> named_struct('start', {start}, 'rank', {rank}, 'kind', '{kind.name}',"
            f" 'stop', q.e, 'base', {str(kind.base).lower()}, 'score', {score}))"
        )
        arrays.append(made if kind.base else f"filter({made}, x -> x.score >= {least})")
    df = df.withColumn("_pii", F.expr(f"array_sort(concat({', '.join(arrays)}))"))
    return df.select(*[docs[c] for c in docs.columns], "_pii")


def _with(valid: str, m: str) -> str:
    """The condition over another name of the match."""
    return re.sub(r"(?<![\w.'])m(?![\w'])", m, valid)


def joined(found: str, *fields: str) -> str:
    """SQL: the fields of each span joined by colons, spans by commas."""
    return f"array_join(transform({found}, x -> concat_ws(':', {', '.join('x.' + f for f in fields)})), ',')"


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans with and without score."""
    df = spans(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    df = df.withColumn("_pii_base", F.expr("filter(_pii, x -> x.base)"))
    counts = [
        F.expr(f"cast(size(filter(_pii_base, x -> x.kind = '{k.name}')) as bigint)").alias(f"n_{k.name}")
        for k in KINDS
        if k.base
    ]
    return df.select(
        "doc_id",
        *counts,
        F.sha2(F.expr(joined("_pii_base", "kind", "start", "stop")), 256).alias("base_sha256"),
        F.expr(joined("_pii", "kind", "start", "stop")).alias("spans"),
        F.expr(joined("_pii", "kind", "start", "stop", "score")).alias("scored"),
    )
