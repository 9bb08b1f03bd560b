"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words move the score.

Everything is a column expression over one row, so nothing is shuffled and no text leaves the JVM.
The proposals of a kind are all leftmost matches of its pattern that do not overlap.  The text between two
matches gives their places (a running sum of lengths, in blocks of about the square root of their number) and
the words before and after them.

Base kinds are kept whenever their check holds, whatever their score:

=======  =========================================================================
email    a name, ``@`` and a domain of two parts or more
ip       four numbers of at most 255
card     13 to 19 digits, single spaces or hyphens between them, that pass Luhn
phone    ``+`` and 9 to 15 digits
=======  =========================================================================

Further kinds are kept when their score reaches ``THRESHOLD``:

===========  ====================================================================================
iban         country, two check digits and 11 to 30 signs, remainder 1 by mod 97
tel          a number of 3, 3 and 4 digits without ``+``; the area code in brackets counts for it
ssn          3, 2 and 4 digits with hyphens, none of the blocks that are never given out
spelt_email  ``name (at) host (dot) tld`` and the like
===========  ====================================================================================

Adding a kind is adding a row to ``KINDS``.  A score starts at the value of its kind, gains ``CONFIRMED`` by a checksum or form, ``NEAR`` by a word of its kind
within ``REACH`` signs before or after (up to the next proposal), and loses ``AGAINST`` by a word that speaks of orders,
versions or serial numbers.  It is kept between 0 and 1.

Defined results: a null or empty text has no spans; a text of any length is read whole; places are code
points, the end exclusive; rows may repeat and each is judged alone; other columns, whatever their names,
pass through, except that a column of the name asked for is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

THRESHOLD = 0.5
CONFIRMED, NEAR, AGAINST = 0.3, 0.3, 0.3
REACH = 40
SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string,score:double>>"
_AGAINST = r"(?i)(order|invoice|version|serial|isbn|article|part|build|release)[a-z]* ?(no|nr|number|id)?[.:#]*[ ]*$"


@dataclass(frozen=True)
class Kind:
    """One kind: its pattern (Java), the same for engines without look-around, prior score and words near by."""

    name: str
    pattern: str
    plain: str
    prior: float
    near: str
    needs: str  # a text in which this does not occur holds none
    base: bool


# Possessive repeats and look-behind only spare steps; they match what the plain pattern matches.
KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        0.7, r"(?i)(mail|contact|write|kontakt|correo|courriel)", "@", True,
    ),
    Kind(
        "ip",
        r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        0.4, r"(?i)((^|[^a-z])ip([^a-z]|$)|address|host|server|login|adresse)", "digit", True,
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9]){12,}+",
        r"[0-9](?:[\x20-]?[0-9])+",
        0.4, r"(?i)(card|visa|credit|debit|karte|carte|tarjeta|payment)", "digit", True,
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        0.5, r"(?i)(tel|phone|call|fax|mobil|cell|whatsapp|handy)", "+", True,
    ),
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
        r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
        0.5, r"(?i)(iban|account|bank|konto|compte|cuenta)", "digit", False,
    ),
    Kind(
        "tel",
        r"\+[0-9][\x20().0-9-]*|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}",
        r"\+[0-9][\x20().0-9-]*|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}",
        0.3, r"(?i)(tel|phone|call|fax|mobil|cell|whatsapp|handy)", "digit", False,
    ),
    Kind(
        "ssn",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        0.3, r"(?i)(ssn|social security|social insurance)", "digit", False,
    ),
    Kind(
        "spelt_email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]++ ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,24}",
        r"[A-Za-z0-9._%+-]+ ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]+ ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,24}",
        0.3, r"(?i)(mail|contact|write|kontakt|correo|courriel)", "dot", False,
    ),
)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if a string of decimal digits passes the Luhn check; for short strings."""

    def on(backwards: Column) -> Column:
        def step(total: Column, place: Column) -> Column:
            digit = F.substring(backwards, place, F.lit(1)).cast("int")
            doubled = digit * 2
            return total + F.when(place % 2 == 1, digit).when(doubled > 9, doubled - 9).otherwise(doubled)

        return F.aggregate(F.sequence(F.lit(1), F.length(backwards)), F.lit(0), step) % 10 == 0

    return _let(F.reverse(digits), on)


def mod97(account: Column) -> Column:
    """True if an account number (letters and digits, no blanks) has remainder 1 by ISO 7064."""

    def on(turned: Column) -> Column:
        def step(rest: Column, place: Column) -> Column:
            sign = F.ascii(F.substring(turned, place, F.lit(1)))
            return F.when(sign >= 65, (rest * 100 + sign - 55) % 97).otherwise((rest * 10 + sign - 48) % 97).cast("int")

        return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1

    return _let(F.concat(F.substring(account, 5, 100), F.substring(account, 1, 4)), on)


_BYTE = r"0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _holds(kind: Kind, value: Column, before: Column, after: Column) -> Column:
    """Whether a proposal of ``kind`` is one at all."""
    if kind.name == "ip":
        return value.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$")
    if kind.name == "card":
        return _let(_digits(value), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(F.lit(False)))
    if kind.name == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind.name == "email":
        return F.lit(True)
    apart = ~before.rlike(r"[A-Za-z0-9]$") & ~after.rlike(r"^[A-Za-z0-9]")
    if kind.name == "iban":
        return apart & _let(F.replace(value, F.lit(" ")), lambda a: F.when(F.length(a).between(15, 34), mod97(a)).otherwise(F.lit(False)))
    # digits that go on beside the match belong to another number
    apart = apart & ~before.rlike(r"[0-9][ .()-]*$|[+.-]$") & ~after.rlike(r"^[ .-]?[0-9]")
    if kind.name == "tel":
        return ~value.startswith("+") & apart
    if kind.name == "ssn":
        return apart & ~value.rlike(r"^(000|666|9)|-00-|-0000$")
    return ~before.rlike(r"[A-Za-z0-9._%+-]$") & ~after.rlike(r"^[A-Za-z0-9]")


def _confirmed(kind: Kind, value: Column) -> Column:
    if kind.name in ("card", "iban"):
        return F.lit(True)  # the checksum held
    if kind.name == "tel":
        return value.startswith("(")
    if kind.name == "spelt_email":
        return value.rlike(r"[(\[]at[)\]].*[(\[]dot[)\]]")
    return F.lit(False)


def _score(kind: Kind, value: Column, before: Column, after: Column) -> Column:
    gained = F.when(_confirmed(kind, value), CONFIRMED).otherwise(0.0) + F.when(before.rlike(kind.near) | after.rlike(kind.near), NEAR).otherwise(0.0)
    score = F.lit(kind.prior) + gained - F.when(before.rlike(_AGAINST), AGAINST).otherwise(0.0)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 6)


def _running(steps: Column) -> Column:
    """Running sums of an array of longs, in blocks of about the square root of its size."""
    none = F.array().cast("array<bigint>")

    def last(done: Column) -> Column:
        return F.coalesce(F.get(done, F.size(done) - 1), F.lit(0).cast("long"))

    def on(steps: Column) -> Column:
        step = F.ceil(F.sqrt(F.size(steps).cast("double"))).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(1), F.size(steps), step),
            lambda at: F.aggregate(F.slice(steps, at, step), none, lambda done, x: F.concat(done, F.array(last(done) + x))),
        )
        return F.aggregate(blocks, none, lambda done, block: F.concat(done, F.transform(block, lambda x: x + last(done))))

    return _let(steps, on)


def _placed(found: Column, between: Column) -> Column:
    """Matches with their places and the text around them, from the matches and the ``n + 1`` texts between them."""
    ends = _running(F.transform(found, lambda value, i: (F.length(F.get(between, i)) + F.length(value)).cast("long")))
    return F.transform(
        F.arrays_zip(found.alias("value"), ends.alias("end")),
        lambda x, i: F.struct(
            (x["end"] - F.length(x["value"])).alias("start"), x["end"].alias("end"), x["value"].alias("value"),
            F.right(F.get(between, i), F.lit(REACH)).alias("before"), F.left(F.get(between, i + 1), F.lit(REACH)).alias("after"),
        ),
    )


def _spans(text: Column, kind: Kind) -> Column:
    """Spans of one kind in order of their start; ``text`` is not null and cheap to read twice."""

    def on(found: Column) -> Column:
        placed = _let(F.split(text, kind.pattern, -1), lambda between: _placed(found, between))
        kept = F.filter(placed, lambda x: _holds(kind, x["value"], x["before"], x["after"]))
        scored = F.transform(
            kept,
            lambda x: F.struct(
                F.lit(kind.name).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"),
                _score(kind, x["value"], x["before"], x["after"]).alias("score"),
            ),
        )
        if not kind.base:
            scored = F.filter(scored, lambda x: x["score"] >= THRESHOLD)
        return F.when(F.size(found) > 0, scored)

    return _let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), on)


def find(text: Column, kinds: Sequence[Kind] = KINDS) -> Column:
    """All spans of a text by kind, then start, as ``SPAN``; null text has none.

    A text without any sign that a kind cannot do without is not searched for that kind.
    """
    none = F.array().cast(SPAN)

    def on(known: Column) -> Column:
        whole = known["text"]
        found = []
        for kind in kinds:
            there = known["digits"] if kind.needs == "digit" else F.contains(whole, F.lit(kind.needs))
            found.append(F.coalesce(F.when(there, _spans(whole, kind)), none))
        return F.concat(*found)

    whole = F.coalesce(text, F.lit(""))
    return _let(F.struct(whole.alias("text"), whole.rlike("[0-9]").alias("digits")), on)


def find_documents(docs: DataFrame, text: str = "text", spans: str = "pii") -> DataFrame:
    """``docs`` with a column of all spans."""
    return docs.withColumn(spans, find(F.col(text)))


def span_table(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, kind, start, end, value, score)``: one row per span."""
    found = docs.select(F.col(id_).alias("id"), F.explode(find(F.col(text))).alias("span"))
    return found.select("id", "span.*")


def written(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _sql_rules() -> dict[str, tuple[str, str]]:
    """Per kind the SQL of its check and of its confirmation, over v (value), b (before) and a (after)."""
    digits = "regexp_replace(v, '[^0-9]', '', 'g')"
    apart = "NOT regexp_matches(b, '[A-Za-z0-9]$') AND NOT regexp_matches(a, '^[A-Za-z0-9]')"
    alone = f"{apart} AND NOT regexp_matches(b, '[0-9][ .()-]*$|[+.-]$') AND NOT regexp_matches(a, '^[ .-]?[0-9]')"
    doubled = f"list_transform(range(1, length({digits}) + 1), lambda i: CAST(substr(reverse({digits}), i, 1) AS INT) * (CASE WHEN i % 2 = 1 THEN 1 ELSE 2 END))"
    luhn_sql = f"list_sum(list_transform({doubled}, lambda x: CASE WHEN x > 9 THEN x - 9 ELSE x END)) % 10 = 0"
    compact = "replace(v, ' ', '')"
    turned = f"(substr({compact}, 5) || substr({compact}, 1, 4))"
    values = f"list_transform(range(1, length({turned}) + 1), lambda i: CASE WHEN ascii(substr({turned}, i, 1)) >= 65 THEN ascii(substr({turned}, i, 1)) - 55 ELSE ascii(substr({turned}, i, 1)) - 48 END)"
    mod_sql = f"list_reduce(list_prepend(0, {values}), lambda r, x: (CASE WHEN x >= 10 THEN r * 100 ELSE r * 10 END + x) % 97) = 1"
    return {
        "email": ("true", "false"),
        "ip": (f"regexp_matches(v, '^{_BYTE}\\.{_BYTE}\\.{_BYTE}\\.{_BYTE}$')", "false"),
        "card": (f"CASE WHEN length({digits}) BETWEEN 13 AND 19 THEN {luhn_sql} ELSE false END", "true"),
        "phone": (f"length({digits}) BETWEEN 9 AND 15", "false"),
        "iban": (f"{apart} AND CASE WHEN length({compact}) BETWEEN 15 AND 34 THEN {mod_sql} ELSE false END", "true"),
        "tel": (f"NOT starts_with(v, '+') AND {alone}", "starts_with(v, '(')"),
        "ssn": (f"{alone} AND NOT regexp_matches(v, '^(000|666|9)|-00-|-0000$')", "false"),
        "spelt_email": ("NOT regexp_matches(b, '[A-Za-z0-9._%+-]$') AND NOT regexp_matches(a, '^[A-Za-z0-9]')", "regexp_matches(v, '[(\\[]at[)\\]].*[(\\[]dot[)\\]]')"),
    }


def spans_sql(rows: str) -> str:
    """DuckDB SQL for ``(r, kind_no, kind, start, end_, score)`` of ``rows`` (r, t), by the same rules."""
    rules, parts = _sql_rules(), []
    for number, kind in enumerate(KINDS):
        holds, confirmed = rules[kind.name]
        near = f"regexp_matches(b, '{kind.near}') OR regexp_matches(a, '{kind.near}')"
        score = f"{kind.prior} + CASE WHEN {confirmed} THEN {CONFIRMED} ELSE 0 END + CASE WHEN {near} THEN {NEAR} ELSE 0 END - CASE WHEN regexp_matches(b, '{_AGAINST}') THEN {AGAINST} ELSE 0 END"
        kept = "true" if kind.base else f"score >= {THRESHOLD}"
        parts.append(f"""
SELECT r, {number} AS kind_no, '{kind.name}' AS kind, "end" - length(v) AS start, "end" AS end_, score FROM (
  SELECT *, round(greatest(0, least(1, {score})), 6) AS score FROM (
    SELECT r, m[i] AS v, right(g[i], {REACH}) AS b, left(g[i + 1], {REACH}) AS a,
           CAST(sum(length(g[i]) + length(m[i])) OVER (PARTITION BY r ORDER BY i) AS BIGINT) AS "end"
    FROM (SELECT r, m, g, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT r, regexp_extract_all(t, '{kind.plain}') AS m, string_split_regex(t, '{kind.plain}') AS g FROM {rows}))
  ) WHERE {holds}
) WHERE {kept}""")
    return "\nUNION ALL".join(parts)
