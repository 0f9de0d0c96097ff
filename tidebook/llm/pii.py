"""Personal data by bootstrapped contextual extraction.

Exact rules find the seed entities: e-mail addresses, IPv4 addresses, payment cards that
pass Luhn's check and international phone numbers. From there on the method learns. The seeds
and every identifier-like token of the corpus (8 characters or more, a digit among them) are
instances; each occurrence has lexical patterns: the word before it with its joining mark
(``left token =``), the word after it, its form (alphabet and length) and its kind (a token
of up to 11 or of 12 and more characters). Spark scores the bipartite graph of patterns and
instances in rounds:

* a pattern is as good as the mean confidence of its instances, where an instance not yet
  scored counts a fifth, tokens that stand after many different words count as wrong, and
  so does every place where the pattern's word stands beside an ordinary word;
* an instance is as good as its patterns together (noisy or); seeds stay at 1.

So seeds induce patterns, patterns promote instances, and these induce further patterns.
Instances of high confidence are the identifiers that no rule describes. No word list takes
part; ``cues`` may name words that are trusted from the start (none by default).

Nulls: a null text is empty. Repeated rows each get a result. An empty table gives an
empty result. Very long texts are read whole; every rule runs in linear time. Found spans of
a text never overlap one another nor the base spans.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.llm import _shared

KINDS = ("email", "ip", "card", "phone")
FOUND = "identifier"
#: Rounds of scoring; confidence from which an instance is found; instances that a pattern needs.
ROUNDS, CONFIDENT, SUPPORT = 4, 0.7, 3
#: The weight of an instance not yet scored; confidence from which it counts as scored; words
#: before a token that make it an ordinary one.
UNKNOWN, SCORED, COMMON = 0.2, 0.5, 8
#: Patterns up to this number are broadcast (some 60 bytes each); beyond it they are shuffled.
BROADCAST_ROWS = 500_000
#: Different words that a task counts before it passes the counts on.
COUNTED = 30_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]")
_HAS_DIGIT = re.compile(r"[0-9]")
#: From a token's first digit on, and the cue word, joining mark and quote before a token.
_TAIL = re.compile(r"[0-9][A-Za-z0-9_+/-]*")
_TOKEN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_+/-")
_WORD = r"(?<![^\W_])([^\W\d_]{2,24})"
_BEFORE = re.compile(_WORD + r"(?:[ \t]{1,2}([=:#]{0,2})|([=:#]{1,2}))[ \t]{0,2}[\"']?\Z")
_AFTER = re.compile(r"[\"']?[ \t]{0,2}([^\W\d_]{2,24})(?![^\W_])")
#: Every word with what joins it to the next token.
_JOINED = re.compile(_WORD + r"(?:[ \t]{1,2}([=:#]{0,2})|([=:#]{1,2}))[ \t]{0,2}(?=[\"']?\S)")
_HEX = frozenset("0123456789abcdef")
_TOKEN_MIN, _LONG = 8, 12


def luhn(digits: str) -> bool:
    """Whether the number passes Luhn's check."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, in time linear in the text."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all rule-based entities, by kind as in ``KINDS``, then start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not _HAS_DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _DIGITS.sub("", m.group())) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def forms(token: str) -> list[str]:
    """A token's form (alphabet and length) and kind, as patterns."""
    if not all(c in _TOKEN for c in token):
        return ["form " + "".join("9" if c in "0123456789" else "x" if c.isalpha() else c for c in token[:64])]
    if set(token) <= _HEX:
        alphabet = "9" if token.isdigit() else "h"
    else:
        alphabet = ("x" if any(c.islower() for c in token) else "") + ("X" if any(c.isupper() for c in token) else "") + "9" + "".join(sorted({c for c in token if not c.isalnum()}))
    return [f"form {alphabet}:{min(len(token), 65)}", "kind long" if len(token) >= _LONG else "kind short"]


def context(text: str, start: int, end: int) -> list[str]:
    """The patterns of the words before and after a place."""
    out = []
    if m := _BEFORE.search(text[max(0, start - 34) : start]):
        out.append(f"left {m[1].lower()} {m[2] or m[3] or ''}")
    if m := _AFTER.match(text[end : end + 30]):
        out.append(f"right {m[1].lower()}")
    return out


def instances(text: str, base: list[tuple[str, int, int]]) -> Iterator[tuple[int, int, str, list[str]]]:
    """(start, end, token, patterns) of identifier-like tokens outside the base spans."""
    taken = sorted((a, b) for _, a, b in base)
    k = 0
    for m in _TAIL.finditer(text):
        start, end = m.span()
        while start and text[start - 1] in _TOKEN:  # runs are disjoint: each is walked once
            start -= 1
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if end - start < _TOKEN_MIN or k < len(taken) and taken[k][0] < end:
            continue
        token = text[start:end]
        yield start, end, token, context(text, start, end) + forms(token)


def observed(text: str, base: list[tuple[str, int, int]]) -> list[dict]:
    """Instances of the graph: identifier-like tokens, and the rule-based entities as seeds."""
    out = [{"start": s, "end": e, "value": v, "patterns": p, "seed": False} for s, e, v, p in instances(text, base)] if _HAS_DIGIT.search(text) else []
    return out + [{"start": s, "end": e, "value": text[s:e], "patterns": context(text, s, e) + forms(text[s:e]), "seed": True} for _, s, e in base]


_SPANS = "array<struct<kind:string,start:long,end:long,value:string>>"
_OBSERVED = "array<struct<start:long,end:long,value:string,patterns:array<string>,seed:boolean>>"
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))
_OBSERVED_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("patterns", pa.list_(pa.string())), ("seed", pa.bool_())]))


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cues: tuple[str, ...] = ()) -> DataFrame:
    """All personal data of each row: doc_id, base and found, arrays of (kind, start, end, value).

    ``base`` holds the rule-based spans by kind as in ``KINDS``, then start; ``found`` the
    spans that the method adds, by start. Offsets count code points, the end is exclusive.
    """
    _shared.tuned(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(_shared.text_slices(b, "text") for b in batches):
            base, other = [], []
            for text in batch.column(1):
                t = text.as_py() or ""
                b = base_spans(t)
                base.append([{"kind": k, "start": s, "end": e, "value": t[s:e]} for k, s, e in b])
                other.append(observed(t, b))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, _SPANS_ARROW), pa.array(other, _OBSERVED_ARROW)], names=["doc_id", "base", "other"])

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = plain.mapInArrow(scan, f"doc_id long, base {_SPANS}, other {_OBSERVED}")
    rows = _shared.written(rows, "spans")
    good = confident_instances(rows, joined_words(docs, text_col), cues)

    # rows are told apart by file and place: repeated rows stay apart
    keyed = rows.select("doc_id", "base", "other", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place"))
    hits = keyed.filter(F.size("other") > 0).select("file", "place", F.inline("other")).filter("not seed").withColumn("instance", F.xxhash64("value"))
    hits = hits.join(good, "instance", "left_semi").select("file", "place", F.struct(F.lit(FOUND).alias("kind"), "start", "end", "value").alias("span"))
    found = hits.groupBy("file", "place").agg(F.array_sort(F.collect_set("span")).alias("found"))  # one row's spans, as many as its text has
    out = keyed.join(found, ["file", "place"], "left")
    return out.select("doc_id", "base", F.coalesce("found", F.expr(f"cast(array() as {_SPANS})")).alias("found"))


def joined_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """How often each word stands before something (pattern ``left``) or at all (``right``): pattern, total."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def dealt() -> pa.RecordBatch:
            left, right = Counter(), Counter()
            for (word, spaced, close), n in seen.items():
                left[f"left {word.lower()} {spaced or close or ''}"] += n
                right[f"right {word.lower()}"] += n
            every = [*left.items(), *right.items()]
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in every], pa.string()), pa.array([n for _, n in every], pa.int64())], names=["pattern", "n"])

        for batch in batches:
            for text in batch.column(0):
                t = text.as_py() or ""
                seen.update(_JOINED.findall(t) if len(t) < 100_000 else (m.groups("") for m in _JOINED.finditer(t)))
                if len(seen) > COUNTED:
                    yield dealt()
                    seen.clear()
        yield dealt()

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "pattern string, n long")
    return counted.groupBy("pattern").agg(F.sum("n").alias("total"))


def confident_instances(rows: DataFrame, totals: DataFrame, cues: tuple[str, ...] = (), rounds: int = ROUNDS, confident: float = CONFIDENT, support: int = SUPPORT) -> DataFrame:
    """Hashes (instance) of values that reach the confidence on the graph of patterns and instances.

    ``rows``: other, as ``extract`` writes it; ``totals``: pattern, total, as ``joined_words``
    counts them. Edges are counted before they are joined, so a token that a third of the
    rows hold is one instance. Context patterns that can't become good, since their word
    mostly stands beside ordinary words, leave the graph before it is scored.
    """
    spark = rows.sparkSession
    seen = rows.filter(F.size("other") > 0).select(F.inline("other")).select(F.xxhash64("value").alias("instance"), "seed", F.explode("patterns").alias("pattern"))
    edges = _shared.written(seen.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.count("*").alias("times")), "edges")
    common = edges.filter("pattern like 'left %'").groupBy("instance").agg(F.count("*").alias("n")).filter(F.col("n") >= COMMON).select("instance", F.lit(True).alias("common"))
    trusted = F.col("pattern").isin([f"left {c} {m}" for c in cues for m in ("", "=", ":")])
    patterns = edges.groupBy("pattern").agg(F.sum("times").alias("held"), F.count("*").alias("instances")).filter((F.col("instances") >= support) | trusted)
    patterns = patterns.join(totals, "pattern", "left").withColumn("ordinary", F.greatest(F.coalesce("total", F.lit(0)) - F.col("held"), F.lit(0)))
    patterns = patterns.filter((F.col("held") >= confident / 2 * (F.col("held") + F.col("ordinary"))) | trusted)
    graph = edges.join(patterns.select("pattern", "instances", "ordinary"), "pattern").join(common, "instance", "left")
    graph = graph.select("pattern", "instance", "instances", "ordinary", F.expr("case when seed then 1.0D when common then 0.0D end").alias("given"), trusted.alias("trusted"))
    graph = _shared.written(graph, "graph")
    _shared.released(edges)
    scores, before = spark.createDataFrame([], "instance long, score double"), []
    for _ in range(rounds):
        now = graph.join(scores, "instance", "left").withColumn("c", F.coalesce("given", "score"))
        mean = F.sum(F.coalesce("c", F.lit(0.0))) / (F.sum(F.when(F.col("c").isNull(), UNKNOWN).otherwise(1.0)) + F.max("ordinary"))
        good = now.groupBy("pattern").agg(F.when(F.max("trusted"), 1.0).otherwise(mean * F.max("instances") / (F.max("instances") + 1)).alias("confidence"))
        patterns = good = _shared.written(good.filter("confidence > 0"), "patterns")
        good = F.broadcast(good) if good.count() <= BROADCAST_ROWS else good
        both = graph.filter("given is null").join(good, "pattern").groupBy("instance")
        scores = both.agg((1 - F.exp(F.sum(F.log1p(-F.least("confidence", F.lit(0.999)))))).alias("score")).filter(F.col("score") >= SCORED)
        scores = _shared.written(scores, "scores")
        _shared.released(patterns, *before)
        before = [scores]
    _shared.released(graph)
    return scores.filter(F.col("score") >= confident).select("instance")


def redacted(docs: DataFrame, text_col: str = "text", cues: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with all entities of each text, base and found, replaced by ``<KIND>``; other columns stay, n_chars follows if there is one.

    The found values are joined as in ``extract`` and may be any number. Only rows that
    hold an identifier-like token are joined with their spans, so other texts are not shuffled.
    """
    _shared.tuned(docs.sparkSession)
    names = docs.columns
    other, file, place, found = (_shared.unused(n, names) for n in ("_other", "_file", "_place", "_found"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = names.index(text_col)
        for batch in itertools.chain.from_iterable(_shared.text_slices(b, text_col) for b in batches):
            texts = (text.as_py() or "" for text in batch.column(k))
            seen = pa.array([observed(t, base_spans(t)) for t in texts], _OBSERVED_ARROW)
            yield pa.RecordBatch.from_arrays([*batch.columns, seen], names=[*names, other])

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = names.index(text_col)
        for batch in itertools.chain.from_iterable(_shared.text_slices(b, text_col) for b in batches):
            out = []
            for text, spans in zip(batch.column(k), batch.column(len(names)), strict=True):
                t = text.as_py()
                out.append(None if t is None else cleaned(t, [(s["start"], s["end"]) for s in spans.as_py() or ()]))
            columns = [pa.array(out, pa.string()) if i == k else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    with_other = T.StructType([*docs.schema.fields, T.StructField(other, T._parse_datatype_string(_OBSERVED))])
    rows = _shared.written(docs.mapInArrow(scan, with_other), "instances")
    good = confident_instances(rows.select(F.col(other).alias("other")), joined_words(docs, text_col), cues)

    # rows are told apart by file and place, as in extract
    keyed = rows.withColumns({file: F.col("_metadata.file_name"), place: F.col("_metadata.row_index")})
    some = F.exists(other, lambda x: ~x["seed"])
    hits = keyed.filter(some).select(F.col(file).alias("file"), F.col(place).alias("place"), F.inline(other)).filter("not seed").withColumn("instance", F.xxhash64("value"))
    hits = hits.join(good, "instance", "left_semi")
    spans = hits.groupBy(F.col("file").alias(file), F.col("place").alias(place)).agg(F.collect_set(F.struct("start", "end")).alias(found))  # one row's spans, as many as its text has
    joined = keyed.filter(some).join(spans, [file, place], "left").select(*names, found)
    plain = rows.filter(~some).select(*names, F.lit(None).cast(joined.schema[found].dataType).alias(found))
    out = plain.unionByName(joined).mapInArrow(replace, docs.schema)
    return out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out


def cleaned(text: str, found: list[tuple[int, int]]) -> str:
    """``text`` with base entities and found spans replaced by ``<KIND>``; of overlapping spans the first stays, longer ones first."""
    spans = [(a, -b, k) for k, a, b in base_spans(text)] + [(a, -b, FOUND) for a, b in found]
    out, at = [], 0
    for a, b, kind in sorted(spans):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
            at = -b
        elif -b > at:  # the rest of an overlapping entity goes too
            at = -b
    return "".join([*out, text[at:]])
