"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import let, pinned, whole_text

# Prefix sums over matches run in blocks, so that a text with many matches stays near linear.
_BLOCK = 64
# Letters before and after a match that are searched for context words.
_NEAR = 48


@dataclass(frozen=True)
class Kind:
    """What proposes a span, what it starts from, and which words nearby speak for or against it.

    ``needs`` is a cheap test that a text without matches usually fails. Possessive repeats and the
    tests of the letter before keep every pattern linear in the text, without changing its matches.
    """

    name: str
    pattern: str
    needs: str
    base: float
    checked: float = 0.0
    words: str = ""
    against: str = ""


# Letters and digits of an account number by country: the public IBAN registry, and countries
# outside it that write their numbers in its form.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU",
}
# The country says how much follows, so what stands after the number does not matter.
_IBAN = "|".join(
    rf"(?:{'|'.join(codes.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{length - 4}}}" for length, codes in IBAN_LENGTHS.items()
)
# Other countries' numbers reach as far as letters and digits do.
_IBAN += rf"|(?!{'|'.join(' '.join(IBAN_LENGTHS.values()).split())})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}+"

BASE = ["email", "ip", "card", "phone"]
# A span is reported at this score or above. Base kinds start there: context cannot take them away.
THRESHOLD = 0.6
KINDS = [
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@", 0.8, words=r"mail|contact|write|address",
    ),
    Kind(
        "ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", 0.6,
        words=r"\bip\b|host|server|address|login|client", against=r"version|release",
    ),
    Kind(
        "card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]", 0.6, 0.2,
        words=r"card|visa|credit|debit|payment|expir", against=r"order|invoice|serial|isbn",
    ),
    Kind(
        "phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.7,
        words=r"phone|call|tel\b|mobile|fax|contact",
    ),
    # Only with a valid mod-97 remainder.
    Kind(
        "iban", rf"(?<![A-Za-z0-9])(?:{_IBAN})(?![A-Za-z0-9])",
        r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]", 0.4, 0.4, words=r"iban|bank|account|konto|compte|cuenta",
    ),
    # Without a checksum: only where a word nearby says what it is.
    Kind(
        "ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.4, words=r"social security|\bssn\b|\bss#", against=r"order|part",
    ),
    Kind(
        "local_phone", r"(?<![0-9+.(-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
        r"[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}", 0.4, words=r"phone|call|tel\b|mobile|fax",
    ),
]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Whether the digits of ``text`` pass the Luhn test: from the right, every second one doubled."""
    digits = F.reverse(F.split(_digits(text), ""))
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    values = F.transform(
        digits, lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int"))
    )
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def mod97(text: Column) -> Column:
    """Whether an account number leaves the remainder 1 of 97, its first four letters put last."""
    plain = F.regexp_replace(text, r"\x20", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(
        F.split(moved, ""), F.lit(0),
        lambda a, c: F.when(value(c) > 9, (a * 100 + value(c)) % 97).otherwise((a * 10 + value(c)) % 97),
    ) == 1


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return found.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        n = F.length(_digits(found))
        # The length is tested first: the Luhn sum of a very long run of digits is never needed.
        return F.when(n.between(12, 19), luhn(found)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(found)).between(9, 15)
    if kind == "iban":
        return mod97(found)
    return F.lit(True)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, v: a + v)


def _sums_before(lengths: Column) -> Column:
    """For each element the sum of those before it: block sums first, then sums within the block."""
    block = lambda i: F.floor(i / _BLOCK).cast("int")
    blocks = lambda all_: F.transform(
        F.sequence(F.lit(0), block(F.size(all_) - 1)),
        lambda b: _total(F.slice(all_, b * _BLOCK + 1, F.lit(_BLOCK))),
    )
    starts = lambda sums: F.transform(
        sums, lambda _, b: F.when(b == 0, 0).otherwise(_total(F.slice(sums, F.lit(1), b)))
    )
    inside = lambda all_, i: F.when(i % _BLOCK == 0, 0).otherwise(
        _total(F.slice(all_, block(i) * _BLOCK + 1, (i % _BLOCK).cast("int")))
    )
    return let(lengths, lambda all_: let(blocks(all_), lambda sums: let(
        starts(sums), lambda first: F.transform(all_, lambda _, i: F.get(first, block(i)) + inside(all_, i))
    )))


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``pii``: an array of ``start, rank, kind, end, score`` sorted by start and kind.

    Places count code points, ends are exclusive; ``rank`` is the kind's place in KINDS. A column
    ``pii`` of ``docs`` is replaced, all others stay. NULL and empty texts have no spans; an empty
    table gives no rows. Each kind's matches are the leftmost non-overlapping ones; those that fail
    the kind's test are dropped without another try. The score is the kind's base, plus its bonus
    where a checksum passed, plus or minus 0.2 for words within 48 letters; spans below THRESHOLD
    go, but for the four base kinds, which are always reported. Only columns are computed: no row
    is shuffled, and whole texts are searched.
    """
    docs = docs.drop("pii")
    frame = docs.withColumn("__text", whole_text(text))
    for kind in KINDS:
        hits = F.when(
            F.col("__text").rlike(kind.needs),
            F.regexp_extract_all("__text", F.lit(kind.pattern), F.lit(0)),
        )
        frame = frame.withColumn(f"__hit_{kind.name}", F.when(F.size(hits) > 0, hits))
    # The gaps between matches give their places. The first gap stands before the first match.
    for kind in KINDS:
        hits = F.col(f"__hit_{kind.name}")
        gaps = F.when(hits.isNotNull(), F.split("__text", kind.pattern, -1))
        frame = frame.withColumn(f"__gap_{kind.name}", gaps)

    def placed(found: Column) -> Column:
        """Start, text and surroundings of each match, out of the matches and the gaps between."""
        hits, gaps, before = found["hits"], found["gaps"], found["before"]
        return F.transform(
            hits,
            lambda h, i: F.struct(
                (F.get(before, i) + F.length(F.get(gaps, i))).alias("start"),
                h.alias("found"),
                F.concat(F.right(F.get(gaps, i), F.lit(_NEAR)), F.lit(" \n "),
                         F.left(F.get(gaps, i + 1), F.lit(_NEAR))).alias("near"),
            ),
        )

    def spans(rank: int, kind: Kind) -> Column:
        hits, gaps = (F.col(f"__{n}_{kind.name}") for n in ("hit", "gap"))
        both = F.struct(hits.alias("hits"), gaps.alias("gaps"))
        steps = lambda b: F.transform(b["hits"], lambda h, i: F.length(F.get(b["gaps"], i)) + F.length(h))
        matches = F.when(hits.isNotNull(), let(both, lambda b: let(
            F.struct(b["hits"].alias("hits"), b["gaps"].alias("gaps"), _sums_before(steps(b)).alias("before")),
            placed,
        )))
        kept = F.filter(matches, lambda s: _valid(kind.name, s["found"]))
        score = lambda near: F.lit(kind.base + kind.checked) + (
            F.when(near.rlike(f"(?i){kind.words}"), 0.2).otherwise(0.0) if kind.words else F.lit(0.0)
        ) - (F.when(near.rlike(f"(?i){kind.against}"), 0.2).otherwise(0.0) if kind.against else F.lit(0.0))
        scored = F.transform(
            kept,
            lambda s: F.struct(
                s["start"].cast("int").alias("start"), F.lit(rank).alias("rank"),
                F.lit(kind.name).alias("kind"),
                (s["start"] + F.length(s["found"])).cast("int").alias("end"),
                F.round(score(s["near"]), 3).alias("score"),
            ),
        )
        if kind.name not in BASE:
            scored = F.filter(scored, lambda s: s["score"] >= THRESHOLD)
        none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,score:double>>")
        return F.coalesce(scored, none)

    each = [spans(rank, kind) for rank, kind in enumerate(KINDS)]
    return frame.select(*docs.columns, pinned(F.array_sort(F.concat(*each))).alias("pii"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each reported span of ``text`` replaced by its kind in angle brackets.

    Overlapping spans are replaced once, by the first that starts. NULL texts stay NULL.
    """
    found = find_spans(docs, text)
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    body = F.aggregate(
        "pii", start,
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                F.concat(a["out"], F.substr(F.col(text), a["at"] + 1, s["start"] - a["at"]),
                         F.lit("<"), s["kind"], F.lit(">")).alias("out"),
                s["end"].alias("at"),
            ),
        ).otherwise(a),
        lambda a: F.concat(a["out"], F.substr(F.col(text), a["at"] + 1)),
    )
    return found.withColumn(text, F.when(F.size("pii") > 0, body).otherwise(F.col(text))).select(*docs.columns)
