"""Personal data: fixed expressions give seeds, seeds give lexical patterns, good patterns give unseen identifiers.

One pass over the whole texts writes, for every document, the spans that the expressions find and all other words
that hold a digit or an @ and all runs of digit groups, each with the words around it. From there on only this small table is read: values and
patterns are the two sides of a graph, and confidence goes back and forth between them in rounds, as joins
and sums over distinct (value, pattern) links, so a thousand copies of a document count once. A pattern is trusted
if SUPPORT different values of a kind stand in it, seeds or values that an earlier round made sure by TRUST, and TRUST
of its values are of that kind. So found identifiers lead to further patterns; after ROUNDS, rounds go on until one
adds no trusted pattern. A word or run in a trusted pattern that has the kind's shape becomes a span of that kind.

Offsets are code points, the end is exclusive. Null and empty texts have no spans. Rows are kept apart also where
they repeat a doc_id; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from visitry.llm.text import stored

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
SUPPORT = 3
TRUST = 0.8
#: Sums of shares depend on their order by less than this.
SLACK = 1e-9
#: Trusted patterns that are sent to the tasks at once when texts are redacted; more need a further pass.
PATTERNS_AT_ONCE = 200_000

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only start where a run of digits does
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@][^\x20\x09-\x0D]*")
#: A maximal run of digit groups joined by a space, dot, hyphen, slash or bracket.
_GROUPS = re.compile(r"(?<![\w@+])[(+]?(?<![0-9])[0-9]++(?:(?:[\x20./-]|\)[\x20./-]?|[\x20./-]?\()[0-9]++)+(?![\w@])")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPACES = " \t\n\x0b\x0c\r"
_EDGES = ".,;:!?\"'()[]{}<>"


def _emails(text: str):
    """Walks from @ to @; the part before is the run of its characters, so no start is tried twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind's number, start, end), by kind, then start."""
    if not text:
        return []
    found = [(0, *s) for s in _emails(text)]
    found += [(1, *m.span()) for m in _IP.finditer(text) if all(len(g.lstrip("0")) < 4 and int(g.lstrip("0") or 0) <= 255 for g in m.groups())]
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group()) if m.end() - m.start() < 64 else ""
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((3, *m.span()))
    return found


def _around(text: str, start: int, end: int) -> list[str]:
    """Patterns of a place: the two words before, the word on each side, the two words behind."""
    before: list[str] = []
    at = start
    while at > 0 and len(before) < 2:
        stop = at
        while stop > 0 and text[stop - 1] in _SPACES:
            stop -= 1
        at = stop
        while at > 0 and text[at - 1] not in _SPACES:
            at -= 1
        if at < stop:
            before.insert(0, text[at:stop].lower())
    behind: list[str] = []
    for m in _WORD.finditer(text, end):
        behind.append(m.group().lower())
        if len(behind) == 2:
            break
    out = []
    if len(before) == 2:
        out.append(" ".join(before) + " _")
    if before and behind:
        out.append(f"{before[-1]} _ {behind[0]}")
    if len(behind) == 2:
        out.append("_ " + " ".join(behind))
    return out


def other_words(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Words with a digit or an @ that touch no span, without punctuation at their edges, and digit groups over several words."""
    found, done = [], 0
    taken = sorted((s, e) for _, s, e in spans)
    for m in _MARK.finditer(text):
        if m.start() < done:
            continue
        start, end = m.span()
        while start > done and text[start - 1] not in _SPACES:
            start -= 1
        done = end
        while start < end and text[start] in _EDGES:
            start += 1
        while end > start and text[end - 1] in _EDGES:
            end -= 1
        while taken and taken[0][1] <= start:
            taken.pop(0)
        if end - start >= 5 and not (taken and taken[0][0] < end):
            found.append((start, end))
    return sorted(found + _groups(text, spans))


def _groups(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs of digit groups with a space inside, which are no single word, that touch no span."""
    found, taken = [], sorted((s, e) for _, s, e in spans)
    at = 0
    for m in _GROUPS.finditer(text):
        start, end = m.span()
        start += m.group().startswith("(") and ")" not in m.group()
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if end - start >= 5 and " " in m.group() and not (at < len(taken) and taken[at][0] < end):
            found.append((start, end))
    return found


def shape_fits(kind: int, value: str) -> bool:
    """Whether an unseen word can be of a kind at all."""
    digits = sum(c in "0123456789" for c in value)
    if kind == 0:
        return "@" in value.strip("@")
    if kind == 1:
        return digits >= 4 and len(re.findall(r"[.:]", value)) >= 3 and not re.search(r"[^0-9A-Fa-f.:/]", value)
    letters = re.search(r"[^0-9\x20().+/-]", value)
    return not letters and (12 <= digits <= 19 if kind == 2 else 7 <= digits <= 15)


_ROW = "doc_id long, spans array<struct<kind:int,start:int,end:int>>, seen array<struct<kind:int,start:int,end:int,value:string,fits:int,patterns:array<string>>>"


def find_marks(docs: DataFrame) -> DataFrame:
    """row, doc_id, spans (of the expressions), seen (spans and other words with their patterns; kind -1: unknown)."""
    fields = T._parse_datatype_string(_ROW)
    schema = to_arrow_schema(fields)

    def one(text):
        spans = base_spans(text)
        seen = []
        for kind, start, end in spans:
            seen.append((kind, start, end, text[start:end].lower(), 0, _around(text, start, end)))
        for start, end in other_words(text, spans) if text else []:
            value = text[start:end].lower()
            fits = sum(1 << k for k in range(len(KINDS)) if shape_fits(k, value))
            seen.append((-1, start, end, value, fits, _around(text, start, end)))
        keys, wide = ("kind", "start", "end"), ("kind", "start", "end", "value", "fits", "patterns")
        return [dict(zip(keys, s, strict=True)) for s in spans], [dict(zip(wide, s, strict=True)) for s in seen]

    def run(batches):
        for batch in batches:
            found = [one(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([f[k] for f in found], schema.field(k + 1).type) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns], schema=schema)

    marked = docs.select("doc_id", "text").mapInArrow(run, fields)
    return stored(marked.withColumn("row", F.monotonically_increasing_id()), "marks")


def _trusted(scores: DataFrame) -> DataFrame:
    """pattern, kind of the patterns whose best kind has SUPPORT and TRUST."""
    # the kind with the largest share decides, the first of equals
    sides = [
        F.struct((F.col(f"c{k}") / F.col("n")).alias("share"), F.lit(-k).alias("first"), F.col(f"s{k}").alias("support"), F.lit(k).alias("kind"))
        for k in range(len(KINDS))
    ]
    best = F.array_max(F.filter(F.array(*sides), lambda s: s["support"] >= SUPPORT))
    return scores.withColumn("best", best).where(F.col("best.share") >= TRUST - SLACK).select("pattern", F.col("best.kind").alias("kind"))


def trusted_patterns(marks: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """pattern, kind: what the graph of values and patterns makes certain."""
    seen = marks.select(F.explode("seen").alias("s")).select("s.*")
    links = stored(seen.select("value", "kind", "fits", F.explode("patterns").alias("pattern")).groupBy("value", "kind", "fits", "pattern").agg(F.lit(1).alias("one")).drop("one"), "links")
    sure = [F.when(F.col("kind") == k, 1.0).otherwise(0.0).alias(f"c{k}") for k in range(len(KINDS))]
    seeds = links.where("kind >= 0").select("value", "pattern", F.lit(True).alias("seed"), *sure)
    open_links = links.where("kind < 0")
    confidence, count, done = None, -1, 0
    while True:
        none = [F.lit(0.0).alias(f"c{k}") for k in range(len(KINDS))]
        others = open_links.select("value", "pattern", F.lit(False).alias("seed"), *none)
        if confidence is not None:
            some = [F.coalesce(f"c{k}", F.lit(0.0)).alias(f"c{k}") for k in range(len(KINDS))]
            others = open_links.join(confidence, "value", "left").select("value", "pattern", F.lit(False).alias("seed"), *some)
        sums = [F.sum(f"c{k}").alias(f"c{k}") for k in range(len(KINDS))]
        # values that an earlier round made sure count as seeds do
        counts = [F.when(F.col("seed"), F.col(f"c{k}")).when(F.col(f"c{k}") >= TRUST - SLACK, 1.0).otherwise(0.0) for k in range(len(KINDS))]
        support = [F.sum(c).alias(f"s{k}") for k, c in enumerate(counts)]
        scores = seeds.union(others).groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), *sums, *support)
        scores = stored(scores.where(F.greatest(*(f"s{k}" for k in range(len(KINDS)))) >= SUPPORT), "scores")
        trusted = _trusted(scores)
        before, count, done = count, trusted.count(), done + 1
        # confidence never falls, so a pattern once trusted stays and an equal count is an equal set
        if done >= rounds and count == before:
            return trusted
        # a value is as sure as the best of its patterns, for kinds whose shape it has
        shares = [
            F.max(F.when((F.col("fits").bitwiseAND(F.lit(1 << k)) != 0) & (F.col(f"s{k}") >= SUPPORT), F.col(f"c{k}") / F.col("n")).otherwise(0.0)).alias(f"c{k}")
            for k in range(len(KINDS))
        ]
        confidence = stored(open_links.join(scores, "pattern").groupBy("value").agg(*shares), "confidence")


def _said(spans: Column) -> Column:
    """kind:start:end by kind, then start, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    say = lambda s: F.concat(F.element_at(names, s["kind"] + 1), F.lit(":"), s["start"], F.lit(":"), s["end"])
    return F.array_join(F.transform(F.array_sort(spans), say), ",")


def extract_identifiers(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, base and all (arrays of kind, start, end) of every row."""
    marks = find_marks(docs)
    trusted = trusted_patterns(marks, rounds)
    unknown = marks.select("row", F.explode("seen").alias("s")).where("s.kind < 0").select("row", "s.*")
    hits = unknown.select("row", "start", "end", "fits", F.explode("patterns").alias("pattern")).join(trusted, "pattern")
    hits = hits.where(F.col("fits").bitwiseAND(F.element_at(F.array(*(F.lit(1 << k) for k in range(len(KINDS)))), F.col("kind") + 1)) != 0)
    span = F.struct("kind", "start", "end")
    added = hits.groupBy("row", "start", "end").agg(F.min("kind").alias("kind")).groupBy("row").agg(F.collect_list(span).alias("added"))
    both = marks.select("row", "doc_id", F.col("spans").alias("base")).join(added, "row", "left")
    return both.select("doc_id", "base", F.concat("base", F.coalesce("added", F.array().cast(both.schema["added"].dataType))).alias("all"))


def span_digest(found: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the expressions' spans, and all spans as text."""
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_said(F.col("base")), 256).alias("base_sha256"), _said(F.col("all")).alias("spans"))


def redact(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """docs with every span in text replaced by its kind in angle brackets; all columns stay.

    The trusted patterns go to the tasks, PATTERNS_AT_ONCE of them a pass, so whole texts are not shuffled.
    """
    trusted = trusted_patterns(find_marks(docs), rounds)
    at, chunks, chunk = docs.columns.index("text"), [], {}
    for row in trusted.toLocalIterator():
        chunk[row["pattern"]] = row["kind"]
        if len(chunk) >= PATTERNS_AT_ONCE:
            chunks.append(docs.sparkSession.sparkContext.broadcast(chunk))
            chunk = {}
    chunks.append(docs.sparkSession.sparkContext.broadcast(chunk))
    # plain names on the way, as the caller may use any
    names, extra = [f"c{i}" for i in range(len(docs.columns))], "added"
    plain = docs.toDF(*names)

    def added(text, patterns):
        """Kind, start and end of the unseen identifiers of a text, one after another."""
        out, base = [], base_spans(text)
        for start, end in other_words(text, base) if text and patterns else []:
            kinds = [patterns[p] for p in _around(text, start, end) if p in patterns]
            kinds = [k for k in kinds if shape_fits(k, text[start:end].lower())]
            if kinds:
                out += [min(kinds), start, end]
        return out

    def collecting(shared):
        def run(batches):
            for batch in batches:
                texts, before = batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()
                spans = [b + added(t, shared.value) for t, b in zip(texts, before, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(spans, pa.list_(pa.int32()))], names=[*names, extra])

        return run

    def replacing(shared):
        def one(text, spans):
            spans = base_spans(text) + [tuple(spans[k : k + 3]) for k in range(0, len(spans), 3)]
            done, parts = 0, []
            for start, _, kind, end in sorted((s, -e, k, e) for k, s, e in spans):
                if start >= done:
                    parts += [text[done:start], f"<{KINDS[kind].upper()}>"]
                done = max(done, end)
            return text if not parts else "".join(parts) + text[done:]

        def run(batches):
            for batch in batches:
                texts, before = batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()
                columns = [*batch.columns[:-1]]
                columns[at] = pa.array([one(t, b + added(t, shared.value)) for t, b in zip(texts, before, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=names)

        return run

    found = plain.withColumn(extra, F.array().cast("array<int>"))
    for shared in chunks[:-1]:
        found = stored(found.mapInArrow(collecting(shared), found.schema), "found")
    return found.mapInArrow(replacing(chunks[-1]), plain.schema).toDF(*docs.columns)
