"""Quality rules by weak supervision: rules vote good or bad or abstain, and a fitted model weighs the votes.

No rule rejects a document alone. Expectation-maximisation over the counts of vote patterns estimates how often each
rule votes which way on good and on bad documents; the verdict is the posterior probability of good. Everything is
DataFrame functions: whole texts are measured row by row in the JVM, without a shuffle; the model sees only the
vote patterns (at most three to the power of the rules), of which a round is one small aggregation.

Null and empty texts have no words: all measures are 0, every rule abstains, the base rule fails them. Repeated rows
count and are judged each; on an empty table nothing is fitted and nothing returned. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitry.llm.text import SPACES, UPPER, stored

SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
# Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = """
the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which
der die das und ist nicht mit von den ein eine im zu dem des sich auf für als auch
le la les de des et un une est que qui dans pour pas sur du au
el los las que y en por con para una del se no es
""".split()
ROUNDS = 40
PRIOR_GOOD = 0.9
#: A rule is written so that it votes bad on at most this share of good documents. Without such a bound the second
#: class may become some large kind of good document instead of the bad ones.
FALSE_ALARMS = 0.01


def _gone(text: Column, letters: str) -> Column:
    """How many characters of the text are among `letters`."""
    return F.length(text) - F.length(F.translate(text, letters, ""))


def measures(docs: DataFrame, keep: str = "doc_id") -> DataFrame:
    """The column `keep` and the measures of the whole text, all long."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, SPACES + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACE_CHARS, "") != "")
    cut = docs.select(keep, text.alias("text"), words.alias("words"), lines.alias("lines"))
    starts = F.sequence(F.lit(1), F.size("words") - (WINDOW - 1))
    hashed = F.when(F.size("words") >= WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
    cut = cut.select(
        keep,
        F.size("words").alias("n_words"),
        (F.length("text") - _gone(F.col("text"), SPACE_CHARS)).alias("word_chars"),
        _gone(F.col("text"), SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        _gone(F.col("text"), UPPER).alias("n_upper"),
        _gone(F.col("text"), "!").alias("n_shouts"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(FUNCTION_WORDS))).alias("n_function"),
        F.size(F.filter("words", lambda w: F.translate(w, SYMBOLS, "") != w)).alias("n_marked"),
        hashed.alias("windows"),
    )
    # only a text with a window that repeats has its windows sorted
    some = F.size("windows") > F.size(F.array_distinct("windows"))
    sort = F.when(some, F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    cut = cut.withColumn("sorted", sort).drop("windows")
    twin = lambda p, j: (F.get("sorted", j - 1)["h"] == p["h"]) | (F.get("sorted", j + 1)["h"] == p["h"])
    again = F.array_sort(F.transform(F.filter("sorted", lambda p, j: F.coalesce(twin(p, j), F.lit(False))), lambda p: p["i"]))
    # each start covers its window, or as much of it as the one before leaves
    covered = F.aggregate(
        again,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, s: F.struct(s.alias("last"), (a["n"] + F.least(F.lit(WINDOW), s - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    names = [c for c in cut.columns if c not in (keep, "sorted")]
    return cut.select(keep, *(F.col(c).cast("long") for c in names), F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def _vote(good: Column, bad: Column) -> Column:
    """1 good, 2 bad, 0 abstains."""
    return F.when(F.col("n_words") < 1, 0).when(bad, 2).when(good, 1).otherwise(0)


def rule_votes() -> dict[str, Column]:
    """The rules; each abstains between its bounds, and where it has too little to see."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "v_length": _vote(share("word_chars", "n_words").between(2.5, 11), ~share("word_chars", "n_words").between(2, 15)),
        "v_symbols": _vote(share("n_symbols", "n_words") <= 0.02, share("n_symbols", "n_words") > 0.1),
        "v_marked": _vote(share("n_marked", "n_words") <= 0.02, share("n_marked", "n_words") > 0.1),
        "v_lines": _vote(share("n_dup_lines", "n_lines") <= 0.1, (share("n_dup_lines", "n_lines") > 0.3) & (F.col("n_lines") > 3)),
        "v_repeats": _vote(share("n_repeat_words", "n_words") <= 0.1, share("n_repeat_words", "n_words") > 0.2),
        "v_function": _vote(share("n_function", "n_words") >= 0.05, (share("n_function", "n_words") < 0.01) & (F.col("n_words") >= 30)),
        "v_upper": _vote(share("n_upper", "word_chars") <= 0.15, share("n_upper", "word_chars") > 0.4),
        "v_shouts": _vote(share("n_shouts", "n_words") <= 0.05, share("n_shouts", "n_words") > 0.3),
        "v_distinct": _vote(share("n_distinct", "n_words") >= 0.3, (share("n_distinct", "n_words") < 0.1) & (F.col("n_words") >= 50)),
    }


def posterior(names: list[str], model: dict) -> Column:
    """Probability of good from a row's votes. Sums in a fixed order, so equal votes give equal values."""
    odds = F.lit(math.log(model["good"] / (1 - model["good"])))
    for name in names:
        weight = {v: math.log(model["rates"][name, v, 1] / model["rates"][name, v, 0]) for v in (1, 2)}
        odds = odds + F.when(F.col(name) == 1, F.lit(weight[1])).when(F.col(name) == 2, F.lit(weight[2])).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-odds))


def fit_votes(patterns: DataFrame, names: list[str], rounds: int = ROUNDS) -> dict:
    """good: share of good documents; rates[rule, vote, class]: how often a rule that votes does so, by class.

    patterns: one column per rule and `n`, the documents with these votes. A rule's rates are those among documents
    on which it votes; one document of either vote is added, so that no rate is zero. FALSE_ALARMS bounds them.
    """
    model = {"good": PRIOR_GOOD, "rates": {}}
    for name in names:
        model["rates"] |= {(name, 1, 1): 1 - FALSE_ALARMS, (name, 2, 1): FALSE_ALARMS, (name, 1, 0): 0.7, (name, 2, 0): 0.3}
    for _ in range(rounds):
        weighed = patterns.withColumn("p", posterior(names, model))
        sums = [F.sum(F.col("n") * F.col("p")).alias("good"), F.sum(F.col("n") * 1.0).alias("all")]
        for name in names:
            for v in (1, 2):
                voted = F.when(F.col(name) == v, F.col("n")).otherwise(0)
                sums += [F.sum(voted * F.col("p")).alias(f"{name}_{v}_1"), F.sum(voted * (1 - F.col("p"))).alias(f"{name}_{v}_0")]
        row = weighed.agg(*sums).first()
        if not row["all"]:
            return model
        rates = {}
        for name in names:
            for c in (0, 1):
                counts = {v: row[f"{name}_{v}_{c}"] + 1 for v in (1, 2)}
                bad = counts[2] / (counts[1] + counts[2])
                bad = min(bad, FALSE_ALARMS) if c else max(bad, FALSE_ALARMS)
                rates |= {(name, 1, c): 1 - bad, (name, 2, c): bad}
        good = min(0.999, max(0.001, row["good"] / row["all"]))
        change = max([abs(good - model["good"]), *(abs(rates[k] - model["rates"][k]) for k in rates)])
        model = {"good": good, "rates": rates}
        if change < 1e-6:
            break
    return model


def judge_quality(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, measures, base_failed, votes, p_good and kept of every row."""
    rules = rule_votes()
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    voted = stored(measures(docs).select("*", failed.alias("base_failed"), *(v.alias(k) for k, v in rules.items())), "votes")
    patterns = stored(voted.groupBy(*rules).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "patterns")
    model = fit_votes(patterns, list(rules), rounds)
    judged = voted.withColumn("p_good", posterior(list(rules), model))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))
