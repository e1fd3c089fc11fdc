"""Toxicity: a weighted grammar of clauses, composed of letter transducers, with stems learnt from labels.

A text becomes one symbol for each word: insult (three strengths), threat, target, negation, report, quotation mark,
clause end, other. Four transducers read it, each the output of the one before:

- negation: an insult or threat within three words after a negation is a negated one;
- report: what follows a verb of saying in its clause, or stands in quotation marks after one, is reported;
- target: with a target in its clause an insult is an attack, and a threat counts at all; the target may follow;
- clause: what a clause end leaves behind.

They are composed to one table (state, symbol) -> (state, output). The outputs are the kinds of matches; a text is
scored by how many of each it has against how many its length lets expect, the weights of the kinds being logarithms
of their rates in toxic and in clean texts, counted by Spark over the labelled texts, and two parameters make the sum
a probability. A text without a lexicon word is never run through the table.

The lexicon is a small fixed one and the stems learnt: beginnings of words that stand in many different contexts (the
words before and after) of toxic texts and in few of clean ones. As contexts are counted, copies of a text add
nothing. Stems need a fixed share of all toxic contexts, so there are never more than MAX_STEMS.

Null, empty and blank texts match nothing and get the score of a text without words. Repeated labels of a document
count as toxic if one of them is; rates are counted over different texts, so repeated rows add nothing. Without any
label the fixed lexicon's prior weights are used. Labels, lang, source and doc_id are no inputs of a score.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitry.llm.classifier import held_out
from visitry.llm.text import map_lists, stored

# The words the grammar knows before it learns, in four languages.
INSULTS = "idiot idiots moron morons stupid loser losers scum trash pathetic worthless disgusting clown dumb imbecile jerk filth vermin dumm dummkopf trottel abschaum widerlich wertlos imbécile crétin débile ordure minable idiota estúpido imbécil basura asqueroso patético".split()
THREATS = "kill hurt destroy beat punish regret suffer die töten umbringen vernichten bereuen tuer détruire frapper regretter mourir matar destruir golpear morir".split()
TARGETS = "you your yours yourself u he she they them him her these those people du dich dir ihr euch sie er tu te toi vous ton ta il elle ils eux tú usted ustedes ellos ellas él ella".split()
NEGATIONS = "not no never nobody isn aren don nicht kein keine nie niemals ne pas jamais aucun nunca jamás ni".split()
REPORTS = "said says say told wrote writes quoted quote reported claimed called sagte sagt schrieb zitiert nannte dit écrit cite dijo dice escribió citó".split()

# Symbols of words; the transducers' inputs.
STRONG, MEDIUM, WEAK, THREAT, TARGET, NEGATION, REPORT, QUOTE, END, OTHER = "123TYNRQEO"
INSULT = STRONG + MEDIUM + WEAK
# Outputs beside these: negated and reported offences, attacks by strength, a threat or target that completes an attack.
NEGATED, REPORTED, ATTACKS, MENACE, AIMED = "n", "r", {STRONG: "a", MEDIUM: "b", WEAK: "c"}, "t", "y"
#: Kinds of matches that are counted.
KINDS = "123abctynr"

#: A stem has at least this share of all toxic contexts, 1/SHARE of them.
SHARE = 10_000
#: Lengths of learnt stems, in characters.
SHORTEST, LONGEST = 4, 12
#: No more stems than this can have the share: each context has one word, with one stem of each length.
MAX_STEMS = SHARE * (LONGEST - SHORTEST + 1)
#: A stem's log-rate ratio, less Z standard errors, must be over LEAST.
Z, LEAST = 3.0, math.log(4)
#: Log-rate ratios from which a stem is strong or medium.
STRENGTHS = (math.log(100), math.log(25))
#: Labelled documents that are learnt from, at most, chosen by a hash of their ids. The labels are sent to all tasks.
MAX_LABELS = 2_000_000
#: Prior weights of the kinds, as pseudo-counts: so many matches in clean texts, and so many times that in toxic ones.
PRIOR, PRIOR_RATIO = 0.5, {**dict.fromkeys("123", 20), **dict.fromkeys("abc", 40), "t": 20, "y": 10, "n": 4, "r": 4}
#: Words in which the prior expects one match of each kind.
PRIOR_WORDS = 5000
#: Evidence beyond this counts as this; it is calibrated in so many bins.
FAR, BINS = 40.0, 640

_WORDS = re.compile(r"[^\W\d_]+|[.!?;\n]|[\"«»“”„]")
Transducer = tuple[list, Callable]


def _negation() -> Transducer:
    def step(left, s):
        if s == NEGATION:
            return 3, OTHER
        if s == END:
            return 0, END
        if left and s in INSULT + THREAT:
            return left - 1, NEGATED
        return max(left - 1, 0), s

    return [0, 1, 2, 3], step


def _report() -> Transducer:
    def step(state, s):
        if s == REPORT:
            return "said", OTHER
        if s == QUOTE:
            return ("quoting" if state == "said" else ""), OTHER
        if s == END:
            return ("quoting" if state == "quoting" else ""), END
        return state, (REPORTED if state and s in INSULT + THREAT else s)

    return ["", "said", "quoting"], step


def _target() -> Transducer:
    def step(state, s):
        aimed, offence, done = state
        if s == END:
            return (False, "", False), END
        if s == TARGET:
            if offence and not done:
                return (True, offence, True), AIMED
            return (True, offence, done), OTHER
        if s in INSULT:
            return (aimed, "insult", done or aimed), (ATTACKS[s] if aimed else s)
        if s == THREAT:
            return (aimed, offence or "threat", done or aimed), (MENACE if aimed else OTHER)
        return state, s

    return [(a, o, d) for a in (False, True) for o in ("", "insult", "threat") for d in (False, True)], step


def compose(transducers: Iterable[Transducer], symbols: str) -> list[dict[str, tuple[int, str]]]:
    """One table for a chain of letter transducers, state 0 first: table[state][symbol] = (state, output)."""
    parts = list(transducers)
    states = list(itertools.product(*(s for s, _ in parts)))
    number = {s: i for i, s in enumerate(states)}
    table = []
    for state in states:
        row = {}
        for symbol in symbols:
            after, out = [], symbol
            for (_, step), s in zip(parts, state, strict=True):
                s, out = step(s, out)
                after.append(s)
            row[symbol] = (number[tuple(after)], out)
        table.append(row)
    return table


def grammar() -> list[dict[str, tuple[int, str]]]:
    return compose([_negation(), _report(), _target()], STRONG + MEDIUM + WEAK + THREAT + TARGET + NEGATION + REPORT + QUOTE + END + OTHER)


class Lexicon:
    """Symbols of words: the fixed words, then the longest learnt stem that a word begins with."""

    def __init__(self, stems: dict[str, str]):
        self.stems = stems
        self.fixed = {w: s for s, ws in ((STRONG, INSULTS), (THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}
        self.fixed |= {**dict.fromkeys(".!?;\n", END), **dict.fromkeys('"«»“”„', QUOTE)}
        self.seen: dict[str, str] = {}

    def symbol(self, word: str) -> str:
        known = self.seen.get(word)
        if known is None:
            known = self.fixed.get(word) or next((self.stems[word[:k]] for k in range(min(len(word), LONGEST), SHORTEST - 1, -1) if word[:k] in self.stems), OTHER)
            if len(self.seen) >= 200_000:
                self.seen.clear()
            self.seen[word] = known
        return known


def matches(symbols: str, table: list[dict[str, tuple[int, str]]]) -> list[tuple[int, str]]:
    """(place, kind) of every match in a sequence of symbols."""
    state, out = 0, []
    for i, symbol in enumerate(symbols):
        state, made = table[state][symbol]
        if made in KINDS:
            out.append((i, made))
    return out


_OFFENCE = re.compile(f"[{INSULT}{THREAT}]")


def symbols_of(text: str, lexicon: Lexicon) -> tuple[str, int]:
    """A text's symbols, and how many of them are words."""
    tokens = _WORDS.findall(text.lower())
    symbols = "".join(map(lexicon.symbol, tokens))
    return symbols, len(tokens) - symbols.count(END) - symbols.count(QUOTE)


def training_labels(labels: DataFrame, parts: int, part: int, most: int = MAX_LABELS) -> DataFrame:
    """doc_id, y of at most about `most` labelled documents that are not held out."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id"), parts, part))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    n = known.count()
    return known.where(F.pmod(F.xxhash64("doc_id"), F.lit(n)) < most) if n > most else known


def learn_stems(texts: DataFrame) -> dict[str, str]:
    """Learnt stems with their strength; texts: text, y (0 or 1)."""

    def make():
        def step(batch_texts, ys):
            words, contexts, labels = [], [], []
            for text, y in zip(batch_texts, ys, strict=True):
                seen = set()
                tokens = [w for w in _WORDS.findall((text or "").lower()) if w[0].isalpha()]
                for before, word, after in zip(["", *tokens], tokens, [*tokens[1:], ""], strict=False):
                    if len(word) >= SHORTEST:
                        seen.add((word, zlib.crc32(f"{before} {after}".encode())))
                words += [w for w, _ in seen]
                contexts += [c for _, c in seen]
                labels += [y] * len(seen)
            return words, contexts, labels

        return step

    found = map_lists(texts, ["text", "y"], "word string, context long, y int", make).distinct()
    counts = found.groupBy("word").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean"))
    counts = stored(counts, "words")
    total = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    if not total["toxic"] or not total["clean"]:
        return {}
    cut = F.explode(F.transform(F.sequence(F.lit(SHORTEST), F.least(F.length("word"), F.lit(LONGEST))), lambda k: F.substring(F.col("word"), F.lit(1), k)))
    stems = counts.select("toxic", "clean", cut.alias("stem")).groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    stems = stems.where(F.col("toxic") * SHARE >= total["toxic"])  # at most MAX_STEMS
    return choose_stems({r["stem"]: (r["toxic"], r["clean"]) for r in stems.toLocalIterator()}, total["toxic"], total["clean"])


def choose_stems(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, str]:
    """The set of stems, none the beginning of another, that tells toxic from clean contexts best."""

    def ratio(a: int, b: int) -> float:
        return math.log((a + 0.5) / toxic) - math.log((b + 0.5) / clean)

    def gain(a: int, b: int) -> float:
        """Log-likelihood ratio of the stem's rates being as they are and not equal."""
        if ratio(a, b) - Z * math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) < LEAST:
            return 0.0
        p = (a + b) / (toxic + clean)
        return sum(n * math.log(n / (t * p)) for n, t in ((a, toxic), (b, clean)) if n)

    best: dict[str, tuple[float, list[str]]] = {}
    for stem in sorted(counts, key=len, reverse=True):
        own, (below, parts) = gain(*counts[stem]), best.get(stem, (0.0, []))
        taken = (own, [stem]) if own > below + 1e-9 else (below, parts)
        if taken[0] and len(stem) > SHORTEST:
            up = best.get(stem[:-1], (0.0, []))
            best[stem[:-1]] = (up[0] + taken[0], up[1] + taken[1])
        best[stem] = taken
    chosen = {s: ratio(*counts[s]) for stem in counts if len(stem) == SHORTEST for s in best[stem][1]}
    return {s: STRONG if w >= STRENGTHS[0] else MEDIUM if w >= STRENGTHS[1] else WEAK for s, w in chosen.items()}


class Weights:
    """evidence(counts, n): logarithm of how much likelier toxic texts have such counts in n words; then a logistic curve."""

    def __init__(self, toxic: dict[str, float], clean: dict[str, float], curve: tuple[float, float] = (1.0, math.log(0.1))):
        """toxic, clean: matches of each kind for each word."""
        self.each = np.array([math.log(toxic[k] / clean[k]) for k in KINDS])
        self.word = sum(toxic[k] - clean[k] for k in KINDS)
        self.curve = curve

    def evidence(self, counts: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.clip(counts @ self.each - n * self.word, -FAR, FAR)

    def score(self, counts: np.ndarray, n: np.ndarray) -> np.ndarray:
        slope, start = self.curve
        return 1 / (1 + np.exp(-(start + slope * self.evidence(counts, n))))


def _rates(row, y: str) -> dict[str, float]:
    words = float(row[f"{y}_words"] or 0) + PRIOR_WORDS
    return {k: (float(row[f"{y}_{k}"] or 0) + PRIOR * (PRIOR_RATIO[k] if y == "toxic" else 1)) / words for k in KINDS}


def logistic(x: np.ndarray, n: np.ndarray, y: np.ndarray, rounds: int = 30) -> tuple[float, float]:
    """Slope (0 or more) and start of the curve through shares y of n at x, by Newton's method, weakly held to (1, -2)."""
    w, prior, hold = np.array([1.0, -2.0]), np.array([1.0, -2.0]), np.array([1.0, 0.1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(w[0] * x + w[1], -30, 30)))
        slope = np.array([np.sum(n * (y - p) * x), np.sum(n * (y - p))]) - hold * (w - prior)
        v = n * p * (1 - p)
        bend = np.array([[np.sum(v * x * x), np.sum(v * x)], [np.sum(v * x), np.sum(v)]]) + np.diag(hold)
        w = w + np.clip(np.linalg.solve(bend, slope), -1, 1)
    return max(float(w[0]), 0.0), float(w[1])


def _counted(docs: DataFrame, stems: dict[str, str]) -> DataFrame:
    """doc_id, n (words), counts (of KINDS), digest (of the text) of every row."""

    def make():
        table, lexicon = grammar(), Lexicon(stems)

        def step(ids, texts):
            ns, counts = [], []
            for text in texts:
                symbols, n = symbols_of(text or "", lexicon)
                kinds = [k for _, k in matches(symbols, table)] if _OFFENCE.search(symbols) else []
                ns.append(n)
                counts.append([kinds.count(k) for k in KINDS] if kinds else [0] * len(KINDS))
            return ids, ns, counts, [int.from_bytes(hashlib.blake2b((t or "").encode(), digest_size=8).digest(), "big", signed=True) for t in texts]

        return step

    return map_lists(docs, ["doc_id", "text"], "doc_id long, n long, counts array<int>, digest long", make)


def fit(docs: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0) -> tuple[dict[str, str], Weights, DataFrame]:
    """Stems, weights, and the counts of all documents. labels: doc_id, toxic."""
    known = stored(training_labels(labels, parts, part), "labels")
    sent = F.broadcast(known)  # MAX_LABELS rows of two numbers at most
    stems = learn_stems(docs.select("doc_id", "text").join(sent, "doc_id").select("text", "y"))
    counted = stored(_counted(docs, stems), "counted")
    # different texts, so that copies add nothing; n and counts follow from the text
    once = counted.join(sent, "doc_id").groupBy("digest", "y").agg(F.first("n").alias("n"), F.first("counts").alias("counts"))
    once = stored(once, "once")
    sums = []
    for y, is_y in (("toxic", F.col("y") == 1), ("clean", F.col("y") == 0)):
        sums.append(F.sum(F.when(is_y, F.col("n"))).alias(f"{y}_words"))
        sums += [F.sum(F.when(is_y, F.col("counts")[i])).alias(f"{y}_{k}") for i, k in enumerate(KINDS)]
    row = once.agg(*sums).first()
    weights = Weights(_rates(row, "toxic"), _rates(row, "clean"))

    def binned(batches):
        for batch in batches:
            x = weights.evidence(_counts(batch), batch.column("n").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(np.round((x + FAR) / (2 * FAR) * BINS).astype(np.int32)), batch.column("y")], names=["bin", "y"])

    bins = once.mapInArrow(binned, "bin int, y int").groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.mean("y").alias("y")).collect()  # BINS rows
    if bins:
        x, n, y = np.array([[b["bin"] / BINS * 2 * FAR - FAR, b["n"], b["y"]] for b in bins]).T
        weights.curve = logistic(x, n, y)
    return stems, weights, counted


def _counts(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("counts").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(KINDS)).astype(float)


def score_toxicity(docs: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted, n_matches of every row."""
    _, weights, counted = fit(docs, labels, parts, part)

    def scored(batches):
        for batch in batches:
            counts = _counts(batch)
            score = weights.score(counts, batch.column("n").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32)), pa.array(counts.sum(axis=1).astype(np.int64))],
                names=["doc_id", "score", "predicted", "n_matches"],
            )

    out = counted.mapInArrow(scored, "doc_id long, score double, predicted int, n_matches long")
    return out.select("doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"), "score", "predicted", "n_matches")


def toxic_clauses(docs: DataFrame, stems: dict[str, str]) -> DataFrame:
    """doc_id, start, end, clause, kinds of every clause with a match; places in characters, end exclusive."""

    def make():
        table, lexicon = grammar(), Lexicon(stems)

        def step(ids, texts):
            out = []
            for doc, text in zip(ids, texts, strict=True):
                text = text or ""
                tokens = list(_WORDS.finditer(text))
                symbols = "".join(lexicon.symbol(t[0].lower()) for t in tokens)
                if not _OFFENCE.search(symbols):
                    continue
                hits = dict(matches(symbols, table))
                bounds = [-1, *(i for i, s in enumerate(symbols) if s == END), len(symbols)]
                for a, b in itertools.pairwise(bounds):
                    kinds = "".join(hits[i] for i in range(a + 1, b) if i in hits)
                    if kinds:
                        start, end = tokens[a + 1].start(), tokens[b - 1].end()
                        out.append((doc, start, end, text[start:end], kinds))
            return list(map(list, zip(*out, strict=True))) if out else [[] for _ in range(5)]

        return step

    return map_lists(docs, ["doc_id", "text"], "doc_id long, start int, end int, clause string, kinds string", make)
