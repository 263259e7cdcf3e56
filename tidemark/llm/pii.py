"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Only DataFrame functions are used. The positions of a pattern's matches come from the text between
them: ``split`` by the pattern gives the gaps, ``regexp_extract_all`` the matches, and their running
lengths, added up by doubling, the offsets. All repetition is possessive and anchored to where a run begins,
so that matching takes linear time and constant stack. What stands at a place is read from chunks of the
text, so that a text with n matches costs n log n, however long it is.

Defined results: null text is empty (no spans; its redaction stays null); kinds are judged apart, so
spans of two kinds may overlap; repeated rows give the same spans; other columns pass through; an empty
table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters on either side of a span in which context words count, and what one adds to the score.
CONTEXT, CONTEXT_BONUS = 40, 0.25
#: Spans of kinds without a checksum of their own need this score; base kinds are kept at any score.
THRESHOLD = 0.5
#: Code points of the chunks in which a text is looked up; more than CONTEXT.
CHUNK = 256
#: Different characters that the value of a secret has at least.
SECRET_VARIETY = 8


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(items: Column, join: Callable[[Column, Column], Column]) -> Column:
    """All running totals of an array under an associative ``join``: log n passes, each over twice the reach."""

    def reach(k: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1), k)

    def wider(s: Column, k: Column) -> Column:
        return F.transform(s, lambda x, i: F.when(i >= reach(k), join(F.get(s, i - reach(k)), x)).otherwise(x))

    return _let(
        items,
        lambda all_: F.aggregate(F.filter(F.sequence(F.lit(0), F.lit(30)), lambda k: reach(k) < F.size(all_)), all_, wider),
    )


def _chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CHUNK}}}+"), F.lit(0))


def _cut(chunks: Column, begin: Column, end: Column) -> Column:
    """The text from one place to another (0 and up, end exclusive, at most the whole) out of its chunks."""
    first = F.floor(begin / CHUNK).cast("int")
    held = F.slice(chunks, first + 1, F.floor(end / CHUNK).cast("int") - first + 1)
    return F.substr(F.array_join(held, ""), begin - first * CHUNK + 1, F.greatest(end - begin, F.lit(0)))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _octets(m: Column) -> Column:
    """Every part is at most 255, leading zeros aside."""
    part = lambda p: F.ltrim(p, F.lit("0"))
    return F.forall(
        F.split(m, r"\."), lambda p: (F.length(part(p)) < 3) | ((F.length(part(p)) == 3) & (part(p) <= F.lit("255")))
    )


def luhn(number: Column) -> Column:
    """The Luhn checksum of a text of digits holds."""
    at = F.transform(F.split(F.reverse(number), ""), lambda c: F.ascii(c) - 48)

    def weigh(d: Column, i: Column) -> Column:
        twice = d * 2
        return F.when(i % 2 == 0, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(at, weigh), F.lit(0), lambda s, d: s + d) % 10 == 0


def mod97(account: Column) -> Column:
    """The ISO 7064 mod 97-10 checksum of an IBAN (letters, digits and spaces) holds."""
    plain = F.replace(account, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    value = lambda c: F.when(F.ascii(c) < 58, F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(
        F.transform(F.split(turned, ""), value),
        F.lit(0),
        lambda r, v: (F.when(v < 10, r * 10).otherwise(r * 100) + v) % 97,
    )
    return rest == 1


@dataclass(frozen=True)
class Kind:
    """pattern: what proposes a span; hint: a cheap test that every text with a match passes."""

    name: str
    pattern: str
    hint: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    score: float
    words: str
    base: bool = True


def _may_hold_secret(t: Column) -> Column:
    """Plain searches for what every form of a secret holds; the pattern is slow on texts without any."""

    def any_of(text: Column, parts: str) -> Column:
        return reduce(or_, [F.contains(text, F.lit(p)) for p in parts.split()])

    named = any_of(t, "= :") & any_of(F.lower(t), "token secret passw pwd key")
    return named | any_of(t, "AKIA ASIA ghp_ gho_ ghu_ ghs_ ghr_ xox eyJ") | F.contains(t, F.lit("PRIVATE KEY-----"))


def _varied(m: Column) -> Column:
    """A named value looks generated: it holds a digit and many different characters; other forms always count."""
    value = F.regexp_extract(m, _NAMED_SECRET, 1)
    generated = value.rlike("[0-9]") & (F.size(F.array_distinct(F.split(value, ""))) >= SECRET_VARIETY)
    return (F.length(value) == 0) | generated


_LOCAL = "[A-Za-z0-9._%+-]"
# Names that secrets are assigned to, the forms of issued keys, and the frame of a private key.
_NAMED_SECRET = (
    r"(?i:(?<![a-z])(?:token|secret|passwd|password|pwd|api[_-]?key|access[_-]?key|secret[_-]?key|auth[_-]?token))"
    r"[\"']?\s{0,3}[:=]\s{0,3}[\"']?([A-Za-z0-9_/+=.~-]{8,}+)"
)
_ISSUED_SECRET = (
    r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{10,}+"
    r"|eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+)(?![A-Za-z0-9])"
)
_KEY_BLOCK = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]*+-----END [A-Z ]{0,40}PRIVATE KEY-----"

KINDS = (
    Kind(
        "email",
        rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda t: F.contains(t, F.lit("@")),
        lambda m: F.lit(True),
        0.75,
        "mail|contact|write|reach",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda t: t.rlike(r"[0-9]\.[0-9]"),
        _octets,
        0.6,
        r"\bip\b|address|server|host|login",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
        lambda m: F.length(_digits(m)).between(13, 19) & luhn(_digits(m)),
        0.7,
        "card|visa|credit|pay|account",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda t: t.rlike(r"\+[0-9]"),
        lambda m: F.length(_digits(m)).between(9, 15),
        0.6,
        "phone|call|tel|mobile|fax",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"),
        lambda m: mod97(m),
        0.9,
        "iban|bank|account|transfer",
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda t: t.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
        lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$"),
        0.3,
        "ssn|social security|taxpayer",
        base=False,
    ),
    Kind(
        "secret",
        rf"{_NAMED_SECRET}|{_ISSUED_SECRET}|{_KEY_BLOCK}",
        _may_hold_secret,
        _varied,
        0.6,
        "token|secret|passw|credential|private|auth|key",
        base=False,
    ),
)

_SPAN = "array<struct<kind:string,start:int,end:int,value:string,score:double>>"


def _of_kind(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind, from left to right, with code point offsets (end exclusive)."""
    nothing = F.expr(f"cast(array() as {_SPAN})")
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pairs = _let(
        matches,
        lambda all_: F.zip_with(
            F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(all_)),
            all_,
            lambda g, m: F.struct((F.length(g) + F.length(m)).alias("size"), m.alias("value")),
        ),
    )

    def place(found: Column) -> Column:
        ends = _running(F.transform(found, lambda x: x["size"]), lambda a, b: a + b)
        return F.zip_with(
            found,
            ends,
            lambda x, e: F.struct((e - F.length(x["value"])).alias("start"), e.alias("end"), x["value"].alias("value")),
        )

    def score(found: Column, chunks: Column, size: Column) -> Column:
        def scored(x: Column) -> Column:
            before = _cut(chunks, F.greatest(x["start"] - CONTEXT, F.lit(0)), x["start"])
            after = _cut(chunks, x["end"], F.least(x["end"] + CONTEXT, size))
            around = F.lower(F.concat(before, x["value"], after))
            bonus = F.when(around.rlike(kind.words), F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0))
            return F.struct(
                F.lit(kind.name).alias("kind"),
                x["start"].alias("start"),
                x["end"].alias("end"),
                x["value"].alias("value"),
                F.least(F.lit(kind.score) + bonus, F.lit(1.0)).alias("score"),
            )

        return F.transform(found, scored)

    def confirm(found: Column) -> Column:
        scores = _let(
            F.struct(_chunks(text).alias("chunks"), F.length(text).alias("size")),
            lambda x: score(found, x["chunks"], x["size"]),
        )
        return F.when(F.size(found) > 0, scores).otherwise(nothing)

    spans = _let(F.filter(_let(pairs, place), lambda x: kind.valid(x["value"])), confirm)
    if not kind.base:
        spans = F.filter(spans, lambda x: x["score"] >= THRESHOLD)
    return F.when(kind.hint(text), spans).otherwise(nothing)


def spans(text: Column) -> Column:
    """array<struct<kind, start, end, value, score>>: by kind as in KINDS, then by place."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.concat(*[_of_kind(text, k) for k in KINDS])


def described(found: Column, base: bool = False) -> Column:
    """kind:start:end of the spans, comma-joined; ``base`` leaves out the kinds beyond the base ones."""
    names = [k.name for k in KINDS if k.base]
    kept = F.filter(found, lambda x: x["kind"].isin(names)) if base else found
    return F.array_join(
        F.transform(
            kept, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
        ),
        ",",
    )


def _masked(text: Column, kind: Kind) -> Column:
    """The text with each confirmed match of one kind replaced by [KIND]."""
    gaps = F.split(text, kind.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    masks = F.transform(
        matches, lambda m: F.when(kind.valid(m), F.lit(f"[{kind.name.upper()}]")).otherwise(m)
    )
    joined = F.array_join(F.zip_with(gaps, masks, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")
    return F.when(kind.hint(text), joined).otherwise(text)


def _confirmed_masked(text: Column) -> Column:
    """The text with the spans of spans() replaced; those that overlap are one, named after the highest score."""
    number = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k.name, i)])
    names = F.array(*[F.lit(f"[{k.name.upper()}]") for k in KINDS])
    ordered = F.array_sort(
        F.transform(
            spans(text),
            lambda x: F.struct(x["start"], x["end"], (-x["score"]).alias("rank"), number[x["kind"]].alias("kind")),
        )
    )

    def reached(found: Column) -> Column:
        """The spans with the end of all before them, itself included, and that of those before it alone."""
        ends = _running(F.transform(found, lambda x: x["end"]), F.greatest)
        return _let(
            ends,
            lambda e: F.transform(
                found,
                lambda x, i: F.struct(x.alias("x"), F.get(e, i).alias("to"), F.coalesce(F.get(e, i - 1), F.lit(0)).alias("past")),
            ),
        )

    def grouped(found: Column) -> Column:
        """Each span with its group: the least of what precedes it is the best of its own group, later groups being less."""
        group = _running(F.transform(found, lambda x: (x["x"]["start"] >= x["past"]).cast("int")), lambda a, b: a + b)
        ranked = F.zip_with(
            found, group, lambda x, g: F.struct((-g).alias("group"), x["x"]["rank"].alias("rank"), x["x"]["kind"].alias("kind"))
        )
        return F.zip_with(
            found,
            _running(ranked, F.least),
            lambda x, r: F.struct(x["x"]["start"], x["to"], x["past"], r["group"].alias("group"), r["kind"].alias("kind")),
        )

    def masked(found: Column, chunks: Column, size: Column) -> Column:
        def part(x: Column, i: Column) -> Column:
            """The text before a group at its first span, the mask at its last one."""
            gap = F.when(x["start"] >= x["past"], _cut(chunks, x["past"], x["start"])).otherwise(F.lit(""))
            last = F.coalesce(F.get(found, i + 1)["group"] != x["group"], F.lit(True))
            return F.concat(gap, F.when(last, F.get(names, x["kind"])).otherwise(F.lit("")))

        tail = _cut(chunks, F.get(found, F.size(found) - 1)["to"], size)
        return F.concat(F.array_join(F.transform(found, part), ""), tail)

    def replaced(found: Column) -> Column:
        done = _let(
            F.struct(_let(_let(found, reached), grouped).alias("found"), _chunks(text).alias("chunks")),
            lambda x: masked(x["found"], x["chunks"], F.length(text)),
        )
        return F.when(F.size(found) > 0, done).otherwise(text)

    return _let(ordered, replaced)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replaces the spans that spans() confirms in the column ``text``, then what appears beside the masks.

    A mask may end a run of digits that was too long for its kind before. So the kinds that need no context
    are masked once more, kind after kind in the order of KINDS, each in what the kinds before it left.
    """
    out = docs.withColumn(text, F.col(text).cast("string"))
    out = out.withColumn(text, _confirmed_masked(F.col(text)))
    for kind in KINDS:
        if kind.base or kind.score >= THRESHOLD:
            out = out.withColumn(text, _masked(F.col(text), kind))
    return out
