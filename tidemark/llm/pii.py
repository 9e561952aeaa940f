"""Personal data: base patterns, and bootstrapped contextual extraction of further identifiers."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import forget, keep, prepare, with_row_key

# Kinds in the order of reports, and the base patterns of the contract.
KINDS = ("email", "ip", "card", "phone")
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Bootstrapping: a context becomes a pattern with this many different identifiers; change of a
# confidence that counts as none; confidence from which an instance counts as an identifier; digits
# of a unit that is a candidate wherever it stands; confidence from which a pattern proposes whatever
# stands in it.
MIN_SUPPORT = 3
SETTLED = 0.005
CONFIDENT = 0.8
MIN_DIGITS = 4
PROPOSES = 0.5
_MOST_PROPOSALS = 20
_MOST_ROUNDS = 200
# Patterns that workers hold at once while they count contexts; more are counted in several passes.
PATTERNS_AT_ONCE = 200_000

_EMAIL = re.compile(EMAIL)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A digit run that fails fails from each of its digits, and a match ends with its run.
_IP = re.compile(r"(?<![0-9])" + IP)
_CARD = re.compile(CARD)
_PHONE = re.compile(PHONE)
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"\S+")
_NUMBER = re.compile(r"[+(]*[0-9][0-9().+/-]*[,;:!?]*")
_LABEL = re.compile(r"[^\W\d_]+:(?!//)(?=.*\w)")
_EDGE = "\"'`.,;:!?()[]{}<>|*#&%$=+/\\-"


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of EMAIL, found from each @ leftwards: long words without one cost nothing."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (found := _EMAIL.match(text, start)):
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base identifiers, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m.group().split("."))):
                out.append((1, *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and _luhn(digits):
                    out.append((2, *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((3, *m.span()))
    return out


def _plain(word: str) -> str:
    """A context word: lower case, edge punctuation off, digits alike."""
    return _DIGIT.sub("0", word.strip(_EDGE).lower()) or word[:1]


def _pieces(word: str) -> list[tuple[int, int, str, bool, bool]]:
    """Label and value of a word, as (start, end, context word, is a number, may go on)."""
    if not _DIGIT.search(word) and ":" not in word:
        return [(0, len(word), word.strip(_EDGE).lower() or word[:1], False, False)]
    label = _LABEL.match(word)
    cuts = [0, label.end(), len(word)] if label else [0, len(word)]
    out = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        number = _NUMBER.fullmatch(word, a, b) is not None
        out.append((a, b, _plain(word[a:b]), number, number and word[b - 1] not in ".,;:!?"))
    return out


# Pieces longer than this are not remembered, so what a worker remembers is bounded in bytes too.
_REMEMBERED = 64


def _of_piece(piece: str) -> tuple[list[tuple[int, int, str]], list[str], bool, bool]:
    """Units of a text without blanks, their context words, whether digits before may take in the first, and the last those behind."""
    out: list[tuple[int, int, str]] = []
    joins = going = False
    for m in _WORD.finditer(piece):
        for a, b, plain, number, more in _pieces(m.group()):
            if not out:
                joins = number and m.start() == 0 and piece[0] != "+"
            out.append((m.start() + a, m.start() + b, plain))
            going = more and m.end() == len(piece)
    return out, [u[2] for u in out], joins, going


def _look_up(piece: str, cache: dict) -> tuple[list[tuple[int, int, str]], list[str], bool, bool]:
    made = _of_piece(piece)
    if len(piece) <= _REMEMBERED:
        if len(cache) > 300_000:
            cache.clear()
        cache[piece] = made
    return made


def units(text: str, cache: dict) -> list[tuple[int, int, str]]:
    """What can be an identifier or a context word, as (start, end, context word).

    Words, with a label glued to its value split off, and groups of digits one space apart taken together.
    """
    out: list[tuple[int, int, str]] = []
    going = False
    at = 0
    for piece in text.split(" "):
        if piece.isalpha():
            out.append((at, at + len(piece), piece.lower()))
            going = False
            at += len(piece) + 1
            continue
        made, _, joins, more = cache.get(piece) or _look_up(piece, cache)
        if going and joins:
            out[-1] = (out[-1][0], at + made[0][1], out[-1][2])
            made = made[1:]
        for a, b, plain in made:
            out.append((at + a, at + b, plain))
        going = more
        at += len(piece) + 1
    return out


def plain_units(text: str, cache: dict) -> list[str]:
    """The context words of ``units`` alone."""
    out: list[str] = []
    going = False
    for piece in text.split(" "):
        if piece.isalpha():
            out.append(piece.lower())
            going = False
            continue
        _, plains, joins, more = cache.get(piece) or _look_up(piece, cache)
        out += plains[1:] if going and joins else plains
        going = more
    return out


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    word = text[start:end]
    start += len(word) - len(word.lstrip(_EDGE))
    return start, start + len(word.strip(_EDGE))


def free_units(text: str, found: list[tuple[int, int, str]], taken: list[tuple[int, int, int]], wanted) -> Iterator[tuple[int, int, list[str]]]:
    """Units that no base span touches and ``wanted`` (digits, contexts) takes, without punctuation at their edges."""
    busy = sorted((a, b) for _, a, b in taken)
    plains = [u[2] for u in found]
    position = 0
    for i, (start, end, _) in enumerate(found):
        start, end = _trimmed(text, start, end)
        while position < len(busy) and busy[position][1] <= start:
            position += 1
        if start == end or position < len(busy) and busy[position][0] < end:
            continue
        patterns = _beside(plains, i)
        if wanted(sum(c in "0123456789" for c in text[start:end]), patterns):
            yield start, end, patterns


def _beside(plains: list[str], i: int) -> list[str]:
    return contexts(plains[i - 2] if i > 1 else "", plains[i - 1] if i else "", plains[i + 1] if i + 1 < len(plains) else "")


def contexts(left2: str, left1: str, right1: str) -> list[str]:
    """The lexical patterns of one place: the word before, the two before, the words around."""
    if not left1:
        return []
    return [left1, f"{left2} {left1}", f"{left1} _ {right1}"]


def _around(text: str, found: list[tuple[int, int, str]], ends: list[int], start: int, end: int, cache: dict) -> list[str]:
    """Contexts of a base span, in the units that totals are counted in; a unit it covers in part gives its rest."""
    i, j = bisect_right(ends, start), bisect_right(ends, end)
    left = [u[2] for u in found[max(0, i - 2) : i]]
    if i < len(found) and found[i][0] < start:
        left += plain_units(text[found[i][0] : start].rstrip(_EDGE), cache)
    right: list[str] = []
    if j < len(found) and found[j][0] < end:
        right = plain_units(text[end : found[j][1]].lstrip(_EDGE), cache)
        j += 1
    right += [u[2] for u in found[j : j + 1]]
    return contexts(left[-2] if len(left) > 1 else "", left[-1] if left else "", right[0] if right else "")


def _digest(text: str, start: int, end: int) -> str:
    """Values travel as digests: personal data is not written anywhere."""
    return hashlib.md5(text[start:end].lower().encode("utf-8", "surrogatepass")).hexdigest()


SPAN = "array<struct<k:int,s:long,e:long>>"
PLACES = "array<struct<k:int,s:long,e:long,value:string,patterns:array<string>>>"


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans of every text, and the contexts of base spans (kind 0 to 3) and candidates (-1)."""
    span = pa.list_(pa.struct([("k", pa.int32()), ("s", pa.int64()), ("e", pa.int64())]))
    place = pa.list_(pa.struct([
        ("k", pa.int32()), ("s", pa.int64()), ("e", pa.int64()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))]))
    cache: dict = {}
    for batch in batches:
        digests, spans, places = [], [], []
        for text in batch.column(1):
            text = text.as_py() or ""
            base = base_spans(text)
            listed = ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in base)
            digests.append(hashlib.sha256(listed.encode()).hexdigest())
            spans.append([{"k": k, "s": a, "e": b} for k, a, b in base])
            listed_units = units(text, cache) if base or _DIGIT.search(text) else []
            ends = [u[1] for u in listed_units]
            found = [(k, a, b, _around(text, listed_units, ends, a, b, cache)) for k, a, b in base]
            free = free_units(text, listed_units, base, lambda digits, _: digits >= MIN_DIGITS)
            found += [(-1, a, b, patterns) for a, b, patterns in free]
            places.append([{"k": k, "s": a, "e": b, "value": _digest(text, a, b), "patterns": patterns} for k, a, b, patterns in found])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(digests), pa.array(spans, span), pa.array(places, place)], names=["key", "base_sha256", "base", "places"])


FILLED = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string())]


def _count_contexts(wanted: list[str]):
    """How often each wanted pattern's context occurs anywhere, around whatever word."""
    heads = {p.split(" ")[0] if " _ " in p else p.split(" ")[-1] for p in wanted}
    known = set(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        cache: dict = {}
        for batch in batches:
            for text in batch.column(0):
                plains = plain_units(text.as_py() or "", cache)
                last = len(plains) - 1
                for i in [i for i, plain in enumerate(plains) if plain in heads]:
                    if i < last:
                        counts.update(p for p in _beside(plains, i + 1) if p in known)
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["pattern", "n"])

    return run


def _fill(wanted: list[str]):
    """What stands in the wanted patterns and is no candidate by its digits."""
    heads = {p.split(" ")[0] if " _ " in p else p.split(" ")[-1] for p in wanted}
    known = set(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py() or ""
                plains = plain_units(text, cache)
                if any(plains[i - 1] in heads and not known.isdisjoint(_beside(plains, i)) for i in range(1, len(plains))):
                    free = free_units(text, units(text, cache), base_spans(text), lambda digits, ps: digits < MIN_DIGITS and not known.isdisjoint(ps))
                    out += [(key.as_py(), a, b, _digest(text, a, b), ps) for a, b, ps in free]
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), FILLED, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "s", "e", "value", "patterns"])

    return run


def _proposed(rows: DataFrame, patterns: DataFrame) -> DataFrame | None:
    """(key, s, e, value, patterns) of what stands in the patterns. Workers hold a bounded part of them at a time."""
    passes = max(1, -(-patterns.count() // PATTERNS_AT_ONCE))
    out = None
    for i in range(passes):
        wanted = [r["pattern"] for r in patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(passes)) == i).toLocalIterator()]
        if wanted:
            part = rows.mapInArrow(_fill(wanted), "key long, s long, e long, value string, patterns array<string>")
            out = part if out is None else out.unionByName(part)
    return out


def _totals(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, total) over all texts. Workers hold a bounded part of the patterns at a time."""
    spark = texts.sparkSession
    passes = max(1, -(-patterns.count() // PATTERNS_AT_ONCE))
    out = spark.createDataFrame([], "pattern string, n long")
    for i in range(passes):
        part = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(passes)) == i).select("pattern")
        wanted = [r["pattern"] for r in part.toLocalIterator()]  # about PATTERNS_AT_ONCE
        if wanted:
            out = out.union(texts.mapInArrow(_count_contexts(wanted), "pattern string, n long"))
    return out.groupBy("pattern").agg(F.sum("n").alias("total"))


def _supported(weights: DataFrame, sure: DataFrame) -> DataFrame:
    """Patterns with enough confident instances of a kind: rows (pattern, k, weight, members)."""
    support = weights.join(sure, "value").groupBy("pattern", "k").agg(
        F.sum(F.col("n") * F.col("confidence")).alias("weight"),
        F.sum((F.col("confidence") >= CONFIDENT).cast("int")).alias("members"))
    return support.where(F.col("members") >= MIN_SUPPORT)


def _scored(weights: DataFrame, sure: DataFrame, totals: DataFrame) -> DataFrame:
    """Confidence of patterns: rows (pattern, k, p)."""
    return _supported(weights, sure).join(totals, "pattern").select(
        "pattern", "k", F.least(F.lit(1.0), F.col("weight") / F.greatest("total", "weight")).alias("p"))


def score_graph(edges: DataFrame, totals: DataFrame, settled: float = SETTLED) -> DataFrame:
    """Confidence of candidates: rows (value, k, confidence).

    ``edges`` has (pattern, value, k, n): how often an instance stands in a pattern's context; k is
    the kind of a seed, or -1. A pattern's confidence for a kind is the confident share of all
    places where its context occurs, if enough different instances support it. An instance's
    confidence for a kind is the noisy-or over its patterns. Seeds stay at 1. Confidence only grows
    from round to round; it is settled once none grows by more than ``settled``.
    """
    edges = edges.select("pattern", "value", "k", "n")
    seeds = edges.where("k >= 0").select("value", "k").distinct().withColumn("confidence", F.lit(1.0))
    open_edges = edges.where("k < 0").join(seeds.select("value").distinct(), "value", "left_anti")
    sure = seeds
    weights = edges.groupBy("pattern", "value").agg(F.sum("n").alias("n"))
    found = edges.sparkSession.createDataFrame([], "value string, k int, confidence double")
    for _ in range(_MOST_ROUNDS):
        scored = _scored(weights, sure, totals)
        later = keep(open_edges.select("pattern", "value").distinct().join(scored, "pattern").groupBy("value", "k").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-12), 1 - F.col("p")))))).alias("confidence")))
        before = found.withColumnRenamed("confidence", "before")
        grown = later.join(before, ["value", "k"], "left").where(F.col("confidence") - F.coalesce("before", F.lit(0.0)) > settled)
        still = grown.limit(1).count()
        forget(found)
        found = later
        if not still:
            return found
        sure = seeds.unionByName(found)
    raise RuntimeError("confidence did not settle")


def _edges(places: DataFrame) -> DataFrame:
    exploded = places.select("value", "k", F.explode("patterns").alias("pattern"))
    return exploded.groupBy("pattern", "value", "k").agg(F.count("*").alias("n"))


def _count_kind(number: int):
    return F.size(F.filter("base", lambda x: x["k"] == number)).cast("long")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found.

    The counts and base_sha256 are of the base spans; spans has those and the discovered ones, each
    as kind:start:end in code points, by kind, then start. A discovered span has the kind of the
    seeds whose contexts it stands in; n_found counts them.

    1. Base spans are the seeds. Units (see units) with digits outside of them are candidates.
    2. The words around seeds and candidates are patterns, where enough different instances have them.
    3. Every place in the corpus with a pattern's context is counted; Spark scores the graph of
       patterns and instances until no confidence moves, and confident candidates become spans wherever they stand.
    4. Patterns of at least PROPOSES then make candidates of whatever stands in them, with few digits
       or none, and 2 and 3 go on until no new pattern proposes. What they propose becomes a span
       only where it stands in one of them.

    Null text counts as empty; texts are read in whole; repeated rows get the same answer; null and
    repeated identifiers are allowed; an empty table gives an empty result; other columns are not read.
    """
    prepare(docs.sparkSession)
    rows, doc_of = with_row_key(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    rows = rows.select("key", "text")
    extracted = keep(rows.mapInArrow(_extract, f"key long, base_sha256 string, base {SPAN}, places {PLACES}"))
    places = extracted.select("key", F.explode("places").alias("place")).select("key", "place.*")
    every = keep(_edges(places))
    spark = docs.sparkSession
    totals = spark.createDataFrame([], "pattern string, total long")
    counted = proposed = spark.createDataFrame([], "pattern string")
    for _ in range(_MOST_PROPOSALS):
        known = every.groupBy("pattern").agg(F.count_distinct("value").alias("values"))
        useful = keep(known.where(F.col("values") >= MIN_SUPPORT).select("pattern"))
        edges = keep(every.join(useful, "pattern", "left_semi"))
        seeds = edges.where("k >= 0").select("value", "k").distinct().withColumn("confidence", F.lit(1.0))
        weights = edges.groupBy("pattern", "value").agg(F.sum("n").alias("n"))
        # Only patterns with enough confident instances are scored, so only their places are counted.
        # A pattern that is not counted yet adds nothing, and confidence only grows, so the end is the
        # same as with all patterns counted beforehand.
        for _ in range(_MOST_ROUNDS):
            found = score_graph(edges, totals)
            fresh = keep(_supported(weights, seeds.unionByName(found)).select("pattern").distinct().join(counted, "pattern", "left_anti"))
            if not fresh.limit(1).count():
                break
            totals = totals.unionByName(keep(_totals(rows.select("text"), fresh)))
            counted = counted.unionByName(fresh)
        else:
            raise RuntimeError("patterns did not stop gaining support")
        able = _scored(weights, seeds.unionByName(found), totals).where(F.col("p") >= PROPOSES).select("pattern").distinct()
        able = keep(able.join(proposed, "pattern", "left_anti"))
        filled = _proposed(rows, able)
        if filled is None:
            break
        proposed = proposed.unionByName(able)
        old = places.where("k < 0").select("key", "s", "e")
        filled = filled.dropDuplicates(["key", "s", "e"]).join(old, ["key", "s", "e"], "left_anti").withColumn("k", F.lit(-1))
        filled = keep(filled.select(*places.columns))
        places = places.unionByName(filled)
        every = keep(_edges(places))
    else:
        raise RuntimeError("patterns did not stop proposing")
    found = found.where(F.col("confidence") >= CONFIDENT)
    best = found.groupBy("value").agg(F.max("confidence").alias("confidence")).join(found, ["value", "confidence"])
    best = best.groupBy("value").agg(F.min("k").alias("kind"))
    more = places.where("k < 0").join(best, "value").groupBy("key").agg(
        F.collect_list(F.struct(F.col("kind").alias("k"), "s", "e")).alias("more"))
    none = F.array().cast(SPAN)
    joined = extracted.join(more, "key", "left").withColumn("more", F.coalesce("more", none))
    names = F.array(*[F.lit(k) for k in KINDS])
    listed = F.transform(
        F.array_sort(F.concat("base", "more")),
        lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string")))
    counts = [_count_kind(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    out = joined.select(
        F.col("key").alias("doc_id"), *counts, "base_sha256", F.array_join(listed, ",").alias("spans"), F.size("more").cast("long").alias("n_found"))
    return doc_of(out, "doc_id")
