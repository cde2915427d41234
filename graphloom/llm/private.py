"""P10. Personal information in free text, judged by what the corpus says about its terms.

Candidates are loose shapes: any number of six digits or more, any capital words with a house
number, any two capital words. Some have a form that protected things are known to have (a telephone
number in a usual notation, an official number, a street address, two known name parts); these are
what the estimate starts from. How strongly a term reveals a protected entity is estimated from
co-occurrence over all documents: of the words before a candidate (its cues), the share of known forms
of a kind among all candidates behind them, or the pointwise mutual information with a known name; of
the parts of an unknown name, the share of their occurrences that stand beside such cues. Behind a
cue over the disclosure threshold every candidate is a finding, whatever its notation, and is
replaced by a typed placeholder; a seed number or the name of a node looks alike but its cues tell
nothing, so it stays. Mail addresses, telephone numbers and postal addresses in an unmistakable
notation are findings without a cue.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.text import strip
from graphloom.operators.skew import small_join
from graphloom.sources.shared import materialize

#: A cue must be seen so often with known names, or a number cue so often at all; one of two words
#: more often, for there are many more of them.
LEAST_SUPPORT, LEAST_PAIR_SUPPORT = 3, 5
#: Part of the bits that certainty would give by which a cue must reveal a known name, and the
#: least share of known names.
LEAST_INFORMATION, LEAST_NAME_SHARE = 0.5, 0.2
#: Least share of protected forms among the numbers, or addresses, after a cue.
LEAST_NUMBER_SHARE = 0.8
#: Share of a word's occurrences beside name cues from which it is a name part by itself, and
#: under which it is an ordinary word.
NAME_SHARE, ORDINARY_SHARE = 0.5, 0.2

_SPELLED = r"(?:\s?\[dot\]\s?|\s?\(dot\)\s?|\sdot\s)"
_DOT = rf"(?:\.|{_SPELLED})"
_LABEL = r"[a-z0-9](?:[a-z0-9-]*[a-z0-9])?"
EMAIL = regex.compile(
    rf"(?i)(?<![\w.+@＠-])[a-z0-9][a-z0-9._%+-]*(?:\s?(?:@|＠|\[at\]|\(at\))\s?{_LABEL}(?:{_DOT}{_LABEL})*{_DOT}[a-z]{{2,}}"
    rf"|\sat\s{_LABEL}(?:{_SPELLED}{_LABEL})*{_SPELLED}[a-z]{{2,}})(?![\w-])"
)
#: International, national with area code in brackets, grouped, and bare with exit code.
PHONE = re.compile(
    r"(?<![\w.+/@-])(?:\+\d{1,3}[ .-]?(?:\(0\)[ .-]?)?\d{1,5}(?:[ .-]\d{2,6}){1,5}|\+\d{8,15}|\(0?\d{2,5}\) ?\d{3,5}[ .-]\d{3,6}"
    r"|1[-.]\d{3}[-.]\d{3}[-.]\d{4}"
    r"|\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4}|001\d{10}|07\d{3} \d{6}|0\d{2,4}/\d{5,9}|0\d(?: \d\d){4})(?![\w/]|[.-]\d)"
)
#: Forms of official numbers: 3-2-4 and 3 3 3 digits, 11 digits, letter and 8 digits, and two
#: letters, six digits, one letter.
NUMBER_FORM = re.compile(
    r"\d{3}-\d{2}-\d{4}|\d{3} \d{3} \d{3}|\d{11}|[A-Z]\d{8}|[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D]"
)
IDNUM = re.compile(rf"(?<![\w.+/@-])(?:{NUMBER_FORM.pattern})(?!\w|[./@-]\w)")
NUMBER = re.compile(r"(?<![\w.+/@-])(?:[A-Z]{1,2} ?)?\d+(?:[-./ ]\d+)*(?: ?[A-D])?(?!\w)")
#: Digits that a number needs to be looked at, and those that one has without a known form.
LEAST_DIGITS, MOST_DIGITS = 6, 15

_CAP = r"\p{Lu}[\p{Ll}ß]+"
_TOWN = rf"{_CAP}(?:-{_CAP})*"
_NEXT = r"(?:,\s+|[ \t]*\r?\n[ \t]*)"
_CODE = r"(?:\d{4,6} )"
_STREET = "(?:Ave|Avenue|Road|Rd|Street|St|Lane|Ln|Drive|Boulevard|Blvd|Court|Way|Square|Terrace|Close|Crescent|Parkway)"
ADDRESS = regex.compile(
    rf"(?<![\w-])(?:\d{{1,5}}[A-Za-z]?,? (?:{_CAP} ){{1,3}}{_STREET}\b\.?(?: (?:N|S|E|W|NE|NW|SE|SW)\b)?"
    rf"(?:,? (?:Apt|Apartment|Unit|Suite|Flat)\.? ?\w+)?(?:{_NEXT}{_CODE}?{_TOWN}(?:,? [A-Z]{{2}} \d{{4,6}}(?:-\d{{4}})?)?)?"
    rf"|\d{{1,5}}[a-z]?,? (?:rue|avenue|boulevard|place|chemin|quai)(?: (?:de la|des|du|de|d'|la|le))? ?{_CAP}(?: {_CAP})?{_NEXT}{_CODE}?{_TOWN}"
    rf"|(?:Calle|Avenida|Plaza|Paseo|Camino)(?: (?:de la|del|de|los|las))? {_CAP}(?: {_CAP})?,? \d{{1,5}}[a-z]?(?:{_NEXT}{_CODE}?{_TOWN})?"
    rf"|(?:{_CAP}[ -])*\p{{Lu}}[\p{{Ll}}ß]*(?:straße|strasse|str\.|weg|gasse|platz|allee|ufer|ring) \d{{1,5}} ?[a-z]?\b(?:{_NEXT}{_CODE}?{_TOWN})?"
    rf"|(?:Via|Viale|Piazza|Corso)(?: (?:di|del|della|dei))? {_CAP}(?: {_CAP})?,? \d{{1,5}}[A-Za-z]?(?:{_NEXT}{_CODE}?{_TOWN})?"
    rf"|(?:P\.? ?O\.? Box|Postfach|Apartado|BP) \d{{1,6}}(?:{_NEXT}{_CODE}?{_TOWN})?)"
)
#: What could be an address behind a telling cue: a house number and capital words, in either order, and
#: what follows them up to the town.
_WORDS = rf"{_CAP}(?:[ -](?:(?:de la|del|de|des|du|di|van|von|der|den|am|an der|im) )?{_CAP}){{0,4}}"
_REST = rf"(?:{_NEXT}(?:{_CODE})?{_TOWN}(?: {_TOWN})?(?:,? [A-Z]{{2}} \d{{4,6}})?)?"
WIDE_ADDRESS = regex.compile(rf"(?<![\w-])(?:\d{{1,5}}[A-Za-z]?,? {_WORDS}{_REST}|{_WORDS},? \d{{1,5}}[A-Za-z]?\b{_REST})(?![\w-])")
_PART = (
    r"(?:(?:Mc|Mac|[OD]['’])?\p{Lu}[\p{Ll}]+(?:[-'’]\p{Lu}[\p{Ll}]+)*|(?:\p{Lu}['’])?\p{Lu}{3,}(?:[-'’]\p{Lu}{2,})*|\p{Lu}{2}(?= \p{Lu}{2,}\b)|(?<=\b\p{Lu}{2,} )\p{Lu}{2})"
)
CAPITAL = regex.compile(rf"(?<![\w@.+-]){_PART}(?![\p{{Latin}}\d_@+-])")
#: What stands between the two parts of a name: a blank, a comma, an initial, or particles.
BETWEEN = regex.compile(r" (?:\p{Lu}\. )?|, | (?:(?:van|von|de|da|di|del|dos|la|le|der|den|ten|bin|al|el|zu) ){1,2}")
#: The sign of a mail address.
AT_SIGN = regex.compile(r"(?i)[@＠]|[\[(]at[\])]|(?<=\s)at(?=\s[\w-]+(?:\s?[\[(]dot[\])]|\sdot\s))")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
TOKEN = re.compile(r"\w+|[^\w\s]|\n")
WORD = re.compile(r"[^\W\d_]+")

FOUND = (
    "what string, doc_id bigint, kind string, first int, last int, found_text string, left1 string, left2 string, "
    "right2 string, part_a string, part_b string, n bigint, n_form bigint, n_phone bigint"
)
_TYPES = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
SCHEMA = pa.schema([(x.split()[0], _TYPES[x.split()[1]]) for x in FOUND.split(", ")])


def cues(text: str, start: int, end: int) -> tuple[str, str, str]:
    """The last token, the last two tokens and the next two tokens around a stretch; a line end
    counts as part of the token before it."""
    before: list[str] = []
    for token in TOKEN.findall(text[max(0, start - 48) : start])[-6:]:
        if token == "\n":
            if before and not before[-1].endswith("⏎"):
                before[-1] += "⏎"
        else:
            before.append(token)
    after = [t for t in TOKEN.findall(text[end : end + 48]) if t != "\n"][:2]
    return (before[-1] if before else "^"), " ".join(before[-2:]), " ".join(after)


def word_cues(text: str, start: int) -> tuple[str, str]:
    """The last word before a number and, if a blank or hyphen is all that parts them, the last
    two, lower-cased; '' for none."""
    words = list(WORD.finditer(text[max(0, start - 48) : start].lower()))
    if not words:
        return "", ""
    last = words[-1].group()
    pair = len(words) > 1 and words[-1].start() - words[-2].end() == 1 and words[-1].string[words[-2].end()] in " -"
    return last, f"{words[-2].group()} {last}" if pair else ""


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Places of mail addresses: from each sign back over the local part, then matched as a whole."""
    done = 0
    for sign in AT_SIGN.finditer(text):
        start = sign.start()
        start -= start > 0 and text[start - 1].isspace()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = EMAIL.match(text, start)
        if m is not None and m.end() > sign.end():
            done = m.end()
            yield m.span()


class Counts:
    """What a batch of texts adds to the statistics: capital words; by cue the numbers behind it, those of
    an official form, telephone numbers; and addresses, loose ones and those of a known form."""

    def __init__(self) -> None:
        self.words, self.numbers, self.forms, self.phones, self.places, self.addresses = (Counter() for _ in range(6))

    def rows(self) -> Iterator[tuple]:
        empty = (None,) * 5
        for word, n in self.words.items():
            yield "token", None, None, None, None, word, *empty, n, None, None
        for cue in self.numbers.keys() | self.phones.keys():
            yield "cue", None, None, None, None, cue, *empty, self.numbers[cue], self.forms[cue], self.phones[cue]
        for cue, n in self.places.items():
            yield "place", None, None, None, None, cue, *empty, n, self.addresses[cue], None


def _official(text: str, start: int, end: int) -> re.Match | None:
    """The first number of an official form within a stretch of digits; it may begin behind others."""
    found = IDNUM.match(text, start)
    return found if found is not None else IDNUM.search(text[:end + 2], start) if end - start > 12 and " " in text[start:end] else None


def scan_text(doc_id: int, text: str, counts: Counts) -> Iterator[tuple]:
    """Candidates of one text as rows of FOUND; counts words, numbers and addresses on the way."""
    taken = bytearray(len(text))
    none = (None,) * 6

    def free(start: int, end: int) -> bool:
        return not any(taken[start:end])

    sure = [("email", *span) for span in emails(text)]
    sure += [("address", *m.span()) for m in ADDRESS.finditer(text)]
    sure += [("phone", *m.span()) for m in PHONE.finditer(text)]
    for kind, start, end in sure:
        if free(start, end):
            taken[start:end] = b"\1" * (end - start)
            if kind == "phone":
                counts.phones.update(word_cues(text, start))
            elif kind == "address":
                cue = cues(text, start, end)[1]
                counts.places[cue] += 1
                counts.addresses[cue] += 1
            yield "sure", doc_id, kind, start, end, text[start:end], None, None, *none
    for m in WIDE_ADDRESS.finditer(text):
        if free(*m.span()):
            cue = cues(text, *m.span())[1]
            counts.places[cue] += 1
            yield "place", doc_id, "address", *m.span(), m.group(), None, cue, *none
    for m in NUMBER.finditer(text):
        start, end = m.span()
        if end - start < LEAST_DIGITS or not free(start, end):
            continue
        digits = sum(map(str.isdigit, m.group()))
        if digits < LEAST_DIGITS:
            continue
        formed = _official(text, start, end)
        beside = word_cues(text, start if formed is None else formed.start())
        for cue in beside:
            counts.numbers[cue] += 1
            counts.forms[cue] += formed is not None
        if formed is not None:
            yield "number", doc_id, "idnum", *formed.span(), formed.group(), *beside, *none
        elif digits <= MOST_DIGITS:
            yield "wide", doc_id, None, start, end, m.group(), *beside, *none
    before = None
    for m in CAPITAL.finditer(text):
        if not free(*m.span()):
            before = None
            continue
        counts.words[m.group().lower()] += 1
        if before is not None and BETWEEN.fullmatch(text, before.end(), m.start()):
            start, end = before.start(), m.end()
            left1, left2, right2 = cues(text, start, end)
            yield (
                "name", doc_id, "name", start, end, text[start:end], left1, left2, right2, before.group().lower(), m.group().lower(), None, None, None,
            )
        before = m


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = Counts()
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows += scan_text(doc, text, counts)
        rows += counts.rows()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), SCHEMA.types, strict=True)], schema=SCHEMA)


def scan(documents: DataFrame) -> DataFrame:
    """All candidates and counts of all texts, whole. Null ids and null texts are left out."""
    return (
        documents.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
        .select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, FOUND)
    )


def telling_cues(scanned: DataFrame) -> DataFrame:
    """(cue, kind): a word, or two, after which candidates have a known form of a kind and hardly ever
    none: ``idnum`` among numbers, ``phone`` among numbers and telephone numbers, ``address`` (two
    tokens) among addresses."""
    least = F.when(F.col("cue").contains(" "), LEAST_PAIR_SUPPORT).otherwise(LEAST_SUPPORT)
    counted = (
        scanned.filter("what IN ('cue', 'place') AND doc_id IS NULL").groupBy("what", F.col("found_text").alias("cue"))
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "n_form", "n_phone")]).filter(F.col("cue") != "")
    )
    kinds = F.when(F.col("what") == "place", F.array(F.struct(F.lit("address").alias("kind"), F.col("n").alias("all"), F.col("n_form").alias("known")))).otherwise(
        F.array(
            F.struct(F.lit("idnum").alias("kind"), F.col("n").alias("all"), F.col("n_form").alias("known")),
            F.struct(F.lit("phone").alias("kind"), (F.col("n") + F.col("n_phone")).alias("all"), F.col("n_phone").alias("known")),
        )
    )
    each = counted.select("cue", F.explode(kinds).alias("k")).select("cue", "k.*")
    return each.filter((F.col("all") >= least) & (F.col("known") >= LEAST_NUMBER_SHARE * F.col("all"))).select("cue", "kind")


def name_cues(candidates: DataFrame) -> DataFrame:
    """(side, cue, bits): cues that raise the odds of a known given and family name. Bits are the
    pointwise mutual information of the cue and a known name among all capital pairs."""
    each = candidates.select(
        "known",
        F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("cue")) for s in ("left1", "left2", "right2")])).alias("x"),
    ).select("x.side", "x.cue", "known")
    base = candidates.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum((F.col("known") == 2).cast("long")), F.lit(0)).alias("k")).head()
    share = max(base["k"], 1) / max(base["n"], 1)
    counted = each.filter(F.col("cue") != "").groupBy("side", "cue").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("known") == 2).cast("long")).alias("k")
    )
    bits = F.log2(F.col("k") / F.col("n") / share)
    return (
        counted.filter(F.col("k") >= LEAST_SUPPORT).withColumn("bits", bits)
        .filter((F.col("bits") >= LEAST_INFORMATION * math.log2(1 / share)) & (F.col("k") >= LEAST_NAME_SHARE * F.col("n"))).select("side", "cue", "bits")
    )


def name_parts(names: DataFrame) -> DataFrame:
    """(part): known parts, stripped and lower-cased, each once."""
    return names.select(F.lower(strip("name_part")).alias("part")).filter(F.col("part") != "").distinct()


def names(scanned: DataFrame, known_parts: DataFrame) -> DataFrame:
    """The candidates that are names. Accepted are pairs beside a telling cue whose parts are
    known or not ordinary words, but for one in the place where names have any word, and pairs of two parts that each are names by themselves."""
    parts = materialize(name_parts(known_parts).withColumn("known", F.lit(1)), "parts")
    candidates = scanned.filter("what = 'name'").select("doc_id", "kind", "first", "last", "found_text", "left1", "left2", "right2", "part_a", "part_b")
    for side in ("a", "b"):
        candidates = small_join(
            candidates, parts.select(F.col("part").alias(f"part_{side}"), F.col("known").alias(f"known_{side}")), [f"part_{side}"], ["doc_id", "first"]
        )
    candidates = candidates.withColumns({f"known_{s}": F.coalesce(f"known_{s}", F.lit(0)) for s in "ab"})
    candidates = materialize(candidates.withColumn("known", F.col("known_a") + F.col("known_b")), "name-candidates")
    telling = materialize(name_cues(candidates), "name-cues")
    for side in ("left1", "left2", "right2"):
        own = telling.filter(F.col("side") == side).select(F.col("cue").alias(side), F.col("bits").alias(f"bits_{side}"))
        candidates = small_join(candidates, own, [side], ["doc_id", "first"])
    beside = F.greatest(F.coalesce("bits_left1", F.lit(0.0)), F.coalesce("bits_left2", F.lit(0.0)))
    after = F.coalesce("bits_right2", F.lit(0.0))
    candidates = candidates.withColumn("led", beside > 0).withColumn("cued", (beside > 0) | ((after > 0) & (F.col("known") >= 1)))
    candidates = materialize(candidates, "cued")
    slots = (
        candidates.filter("cued").select(F.explode(F.array("part_a", "part_b")).alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("slots"))
    )
    tokens = scanned.filter("what = 'token'").groupBy(F.col("found_text").alias("part")).agg(F.sum("n").alias("n"))
    # only words that stood beside a cue; the counts of all others are not looked up
    shares = materialize(slots.join(tokens, "part").select("part", F.least(F.col("slots") / F.col("n"), F.lit(1.0)).alias("share")), "shares")
    for side in ("a", "b"):
        candidates = small_join(
            candidates, shares.select(F.col("part").alias(f"part_{side}"), F.col("share").alias(f"share_{side}")), [f"part_{side}"], ["doc_id", "first"]
        )
    share = {s: F.coalesce(f"share_{s}", F.lit(0.0)) for s in "ab"}
    sound = {s: (F.col(f"known_{s}") == 1) | (share[s] >= ORDINARY_SHARE) for s in "ab"}
    by_itself = {s: share[s] >= NAME_SHARE for s in "ab"}
    # an ordinary word may be the part next to the cue, or the given name after a comma
    turned = F.col("found_text").contains(", ")
    accepted = candidates.filter(
        (F.col("led") & (sound["b"] | (turned & sound["a"]))) | (F.col("cued") & sound["a"] & sound["b"]) | (by_itself["a"] & by_itself["b"])
    )
    # of overlapping pairs the one beside a cue stands, then the earlier one
    order = Window.partitionBy("doc_id").orderBy("first")
    score = F.col("cued").cast("int")
    return (
        accepted.withColumns({
            "before_last": F.lag("last").over(order), "before_cued": F.lag(score).over(order),
            "next_first": F.lead("first").over(order), "next_cued": F.lead(score).over(order),
        })
        .filter(
            (F.col("before_last").isNull() | (F.col("before_last") <= F.col("first")) | (score > F.col("before_cued")))
            & (F.col("next_first").isNull() | (F.col("next_first") >= F.col("last")) | (score >= F.col("next_cued")))
        )
        .select("doc_id", "kind", "first", "last", "found_text")
    )


def findings(documents: DataFrame, known_parts: DataFrame) -> DataFrame:
    """(doc_id, kind, first, last, found_text): every finding with its place in code points.
    Texts without any, and empty ones, give no row; a doc_id that comes again gives the
    findings of all its texts."""
    scanned = materialize(scan(documents), "scanned")
    columns = ["doc_id", "kind", "first", "last", "found_text"]
    telling = materialize(telling_cues(scanned), "telling-cues")
    behind = scanned.filter("what IN ('number', 'wide') OR what = 'place' AND doc_id IS NOT NULL")
    for side in ("left1", "left2"):
        told = telling.groupBy(F.col("cue").alias(side)).agg(F.collect_set("kind").alias(f"by_{side}"))  # three kinds at most
        behind = small_join(behind, materialize(told, side), [side], ["doc_id", "first"])
    empty = F.array().cast("array<string>")
    told = F.array_union(F.coalesce("by_left1", empty), F.coalesce("by_left2", empty))
    # a number of official form is one or nothing; any other is what its cue tells
    kind = (
        F.when(F.col("what") == "place", F.when(F.array_contains("told", "address"), "address"))
        .when(F.array_contains("told", "idnum"), "idnum")
        .when((F.col("what") == "wide") & F.array_contains("told", "phone"), "phone")
    )
    numbers = behind.withColumn("told", told).withColumn("kind", kind).filter("kind IS NOT NULL")
    return scanned.filter("what = 'sure'").select(*columns).unionByName(numbers.select(*columns)).unionByName(names(scanned, known_parts))


def redact(documents: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, text, n_findings): each text with its findings replaced by [EMAIL], [PHONE],
    [IDNUM], [ADDRESS] and [NAME]. ``doc_id`` must be unique. Texts without findings stay as
    they are, null stays null."""
    spans = found.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("first", "last", "kind"))).alias("spans"))
    joined = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(spans, "doc_id", "left")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes = [], []
            for text, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                out, at = [], 0
                for span in own or ():
                    if text is not None and span["first"] >= at:
                        out += [text[at : span["first"]], f"[{span['kind'].upper()}]"]
                        at = span["last"]
                texts.append(None if text is None else "".join([*out, text[at:]]))
                sizes.append(len(own or ()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(sizes, pa.int32())], names=["doc_id", "text", "n_findings"])

    return joined.mapInArrow(replace, "doc_id bigint, text string, n_findings int")
