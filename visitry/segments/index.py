"""Index of rules: many labels evaluated by data, not by one expression for each.

Facts are rows (member, attribute, text or number). A rule that tests a fact becomes postings, rows (attribute, key,
label, step): for a list of texts one for each text, for a range one for each of the few nodes of a binary tree over
the attribute's elementary intervals (the stretches between all bounds that any rule names) that make up the range. A
number meets a node on each level of the tree, so a fact is joined with no rule but those that it satisfies, and
neither facts nor the plan grow with the number of labels.

- attributes, value labels, grades, behaviour, statuses: facts are columns of a table;
- campaign reactions: one attribute for each channel and action, the moment being the number;
- purchase totals: lines are summed by order, channel and elementary interval of all rules' periods; the sums meet
  the periods that hold them by the same kind of tree, and totals are facts of (member, period). Limits that every
  order must keep are bounds of the fact's least and greatest order;
- all other rules are evaluated once for each different rule, and their ids are facts.

Folds are data as well: one letter for each step of a label.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Mapping, Sequence
from datetime import date, datetime, time, timedelta
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import contact_id_clean, resolve_range
from ..functions.numbers import COMPARISONS
from ..operators.sets import WORD, Filtered, union_all
from . import attributes, purchases, remarketing
from .context import SegmentContext, no_ids
from .families import rule_sources

NUMBER = "decimal(38,10)"
CUT = f"struct<v:{NUMBER},side:int>"
#: A bound is a cut (value, side): side 0 lies before the value, 1 behind it. None is no bound.
Cut = tuple[Decimal, int]
Range = tuple[Cut | None, Cut | None]
#: The rules' side is sent to all tasks up to so many rows; beyond, both sides are shuffled.
MOST_SENT = 1_000_000
LETTERS = {"or": "o", "and": "a", "not": "n"}


class Tree:
    """Binary tree over the elementary intervals between cuts."""

    def __init__(self, ranges: Sequence[Range]):
        self.cuts = sorted({c for r in ranges for c in r if c is not None})
        self.levels = len(self.cuts).bit_length() + 1

    def nodes(self, r: Range) -> list[str]:
        """Nodes that make up a range, at most two on a level; none for an empty one."""
        low, high = r
        a = 0 if low is None else bisect_left(self.cuts, low) + 1
        b = len(self.cuts) + 1 if high is None else bisect_left(self.cuts, high) + 1
        out, level = [], 0
        while a < b:
            if a & 1:
                out.append(f"{level}:{a}")
                a += 1
            if b & 1:
                b -= 1
                out.append(f"{level}:{b}")
            a, b, level = a >> 1, b >> 1, level + 1
        return out

    def rows(self) -> list[dict]:
        return [{"v": str(v), "side": s} for v, s in self.cuts]


def _place(cuts: Column, at: Column, levels: int) -> Column:
    """How many cuts lie at or before `at`, by halving steps."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(levels))])

    def step(place: Column, width: Column) -> Column:
        return place + F.when(F.get(cuts, place + width - 1) <= at, width).otherwise(0)

    return F.aggregate(steps, F.lit(0), step)


def _nodes_of(place: Column, levels: int) -> Column:
    """The node of each level over an elementary interval."""
    return F.array(*[F.concat(F.lit(f"{level}:"), F.shiftright(place, level).cast("string")) for level in range(levels + 1)])


def comparison(op=None, value=None, low=None, high=None) -> Range:
    """The range that cmp_predicate tests."""
    if op is not None and op not in COMPARISONS:
        raise ValueError(f"unknown comparison word {op!r}")
    if op and value:
        v = Decimal(str(value))
        return {"=": ((v, 0), (v, 1)), ">=": ((v, 0), None), "<=": (None, (v, 1))}[COMPARISONS[op]]
    if op and low is not None and high is not None:
        return (Decimal(str(low)), 0), (Decimal(str(high)), 1)
    return (Decimal(0), 1), None


def _micros(t: datetime) -> Decimal:
    return Decimal((t - datetime(1970, 1, 1)) // timedelta(microseconds=1))


def _days(d: date) -> Decimal:
    return Decimal((d - date(1970, 1, 1)).days)


class RuleIndex:
    """Rules of many labels as postings; members() looks all facts up in them."""

    def __init__(self, ctx: SegmentContext, folds: Mapping[str, Sequence[tuple[Mapping, str]]]):
        """folds: the rule documents of each label, with how each combines (or, and, not)."""
        self.ctx, self.labels = ctx, list(folds)
        self.programs = ["".join(LETTERS[op] for _, op in steps) for steps in folds.values()]
        #: (attribute, text, label, step) and (attribute, range, limits of the orders, label, step)
        self.listed: list[tuple] = []
        self.ranged: list[tuple] = []
        self.columns: dict[tuple[str, str, str], None] = {}
        self.scopes: dict[tuple, int] = {}
        self.others: dict[str, tuple[int, Mapping]] = {}
        for label, steps in enumerate(folds.values()):
            for step, (doc, _) in enumerate(steps):
                self._add(doc, label, step)

    # --- rules to postings

    def _add(self, doc: Mapping, label: int, step: int) -> None:
        kind, tag, value, more = doc["type"], doc["tag"], doc["value"], doc.get("more_option") or {}
        if kind == "基本屬性" and tag in attributes.LISTED:
            return self._text("member", attributes.LISTED[tag], value, label, step)
        if kind == "基本屬性" and tag in attributes.RANGED and isinstance(value, Mapping):
            bounds = self._bounds(attributes.RANGED[tag], value)
            if bounds:
                attr = self._column("member", attributes.RANGED[tag], "number")
                return self.ranged.append((attr, bounds, None, label, step))
        elif kind == "價值分群" and tag == "價值分群":
            return self._text("member_label", "value_label", value, label, step)
        elif kind == "AI顧客分群" and tag in attributes.AI_COLUMNS:
            return self._text("member_behavior", attributes.AI_COLUMNS[tag], value, label, step)
        elif kind == "消費行為" and tag in purchases.GRADE_COLUMNS:
            return self._text("member_label", purchases.GRADE_COLUMNS[tag], value, label, step)
        elif kind == "消費行為" and tag in purchases.TOTALS:
            return self._total(doc, label, step)
        elif kind == "渠道再行銷" and doc.get("web") in remarketing.CHANNELS and not more.get("event"):
            if self._reaction(doc, more, label, step):
                return None
        name = json.dumps({k: v for k, v in doc.items() if k != "mode"}, sort_keys=True, default=str)
        place = self.others.setdefault(name, (len(self.others), doc))[0]
        return self.listed.append(("rule", str(place), label, step))

    def _column(self, table: str, column: str, kind: str) -> str:
        self.columns[table, column, kind] = None
        return f"{table}.{column}"

    def _text(self, table: str, column: str, values: Sequence, label: int, step: int) -> None:
        attr = self._column(table, column, "text")
        self.listed += [(attr, str(v), label, step) for v in dict.fromkeys(values) if v is not None]

    def _bounds(self, column: str, value: Mapping) -> Range | None:
        """Bounds of a ranged column of members, if they are of the column's kind."""
        low, high = value.get("low"), value.get("high")
        if dict(self.ctx.tables("member").dtypes)[column] == "date":
            try:
                low, high = (x if isinstance(x, date) else date.fromisoformat(x) for x in (low, high))
            except (TypeError, ValueError):
                return None
            return (_days(low), 0), (_days(high), 1)
        if any(isinstance(x, bool) or not isinstance(x, (int, float, Decimal)) for x in (low, high)):
            return None
        return (Decimal(str(low)), 0), (Decimal(str(high)), 1)

    def _reaction(self, doc: Mapping, more: Mapping, label: int, step: int) -> bool:
        tag, web = doc["tag"], doc["web"]
        column, times = remarketing.CHANNELS[web][0], more.get("time_range") or {}
        timed = times.get("days") or (times.get("start_time") and times.get("end_time"))
        if tag in (remarketing.SENDABLE, remarketing.RATING):
            if timed:
                return False
            values = ["normal"] if tag == remarketing.SENDABLE else doc["value"]
            self.columns[tag, column, "clean"] = None
            self.listed += [(f"{tag}.{column}", str(v), label, step) for v in dict.fromkeys(values)]
            return True
        action = remarketing.ACTIONS.get(tag)
        if action is None:
            return False
        if web == "SMS" and action == "open":  # nobody does
            return True
        self.columns["channel_touch", "touch_time", "moment"] = None
        start, end = resolve_range(times, self.ctx.as_of) if timed else (None, None)
        bounds = ((_micros(start), 0), (_micros(end), 1)) if timed else (None, None)
        self.ranged.append((f"touch.{web}.{action}", bounds, None, label, step))
        return True

    def _total(self, doc: Mapping, label: int, step: int) -> None:
        web, tag, value = doc["web"], doc["tag"], doc["value"]
        if web not in purchases.CHANNELS:
            raise ValueError(f"unknown channel {web!r}")
        start, end = resolve_range((doc.get("more_option") or {}).get("time_range"), self.ctx.as_of)
        first = start.date() if start.time() == time() else start.date() + timedelta(days=1)
        scope = self.scopes.setdefault((web, first, end.date()), len(self.scopes))
        count, cost = purchases._options(doc.get("more_option"))
        if tag == purchases.BUYERS:
            self.ranged.append((f"orders.{scope}", comparison(**count), comparison(**cost), label, step))
            return
        measure = {"累計消費金額": "sales", "平均客單價": "basket"}.get(tag, "orders")
        value = value or {}
        bounds = comparison(value.get("moreOrless"), value.get("cost"), value.get("low"), value.get("high"))
        self.ranged.append((f"{measure}.{scope}", bounds, None, label, step))

    # --- facts

    def _facts(self, attr: Column, text: Column, number: Column, least: Column | None = None, most: Column | None = None) -> list[Column]:
        none = F.lit(None)
        return [
            attr.cast("string").alias("attr"), text.cast("string").alias("text"), number.cast(NUMBER).alias("number"),
            (none if least is None else least).cast(NUMBER).alias("least"), (none if most is None else most).cast(NUMBER).alias("most"),
        ]

    def facts(self) -> list[DataFrame]:
        """member_id, attr, text, number, least, most of every table that a rule reads."""
        out, none, key = [], F.lit(None), F.col("member_id").cast("string").alias("member_id")
        by_table: dict[str, list] = {}
        for table, column, kind in self.columns:
            if kind in ("text", "number"):
                by_table.setdefault(table, []).append((column, kind))
        for table, columns in by_table.items():
            df = self.ctx.tables(table)
            kinds = dict(df.dtypes)
            each = []
            for column, kind in columns:
                c, attr = F.col(column), F.lit(f"{table}.{column}")
                number = F.unix_date(c) if kinds[column] == "date" else c
                each.append(F.struct(*(self._facts(attr, c, none) if kind == "text" else self._facts(attr, none, number))))
            rows = df.where(F.col("member_id").isNotNull()).select(key, F.inline(F.array(*each)))
            out.append(rows.where(F.coalesce("text", F.col("number").cast("string")).isNotNull()))
        clean = contact_id_clean(F.col("member_id").cast("string")) & F.col("member_id").isNotNull()
        for tag, column, kind in self.columns:
            if kind == "clean":
                source, text = ("member_status", column) if tag == remarketing.SENDABLE else ("channel_user", "response")
                df = self.ctx.tables(source).where(clean)
                df = df.where(F.col("channel") == column) if source == "channel_user" else df.where(F.col(column) == "normal")
                out.append(df.select(key, *self._facts(F.lit(f"{tag}.{column}"), F.col(text), none)))
        if ("channel_touch", "touch_time", "moment") in self.columns:
            attr = F.concat_ws(".", F.lit("touch"), "channel", "action")
            wanted = sorted({a for a, *_ in self.ranged if a.startswith("touch.")})  # channels x actions at most
            moment = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("touch_time").cast("timestamp_ntz"))
            # a touch without a moment still counts where no range is asked for: it lies before all cuts
            moment = F.coalesce(moment, F.lit(-(10**17)))
            out.append(self.ctx.tables("channel_touch").where(clean & attr.isin(wanted)).select(key, *self._facts(attr, none, moment)))
        if self.scopes:
            out.append(self._purchases())
        if self.others:
            out.append(self._evaluated())
        return out

    def _purchases(self) -> DataFrame:
        """Orders, sales and baskets of each member in each period that some rule names."""
        ranges = {s: ((_days(first), 0), (_days(last), 1)) for (_, first, last), s in self.scopes.items()}
        tree = Tree(list(ranges.values()))
        spread = [(online, node, s) for (web, _, _), s in self.scopes.items() for online in purchases.CHANNELS[web] for node in tree.nodes(ranges[s])]
        # days are whole numbers: a cut behind a day is one before the next
        cuts = F.from_json(F.lit(json.dumps([int(v) + side for v, side in tree.cuts])), "array<int>")
        first, last = min(f for _, f, _ in self.scopes), max(l for *_, l in self.scopes)
        lines = self.ctx.tables("purchase").where(F.col("member_id").isNotNull() & F.col("date").between(F.lit(first), F.lit(last)))
        sums = lines.groupBy("member_id", "order_id", "online", "date").agg(F.sum("sales").alias("total"))
        sums = sums.withColumn("_at", _place(cuts, F.unix_date("date"), tree.levels))
        periods = self._sent(spread, {"online": pa.int32(), "node": pa.string(), "scope": pa.int32()})
        met = sums.withColumn("node", F.explode(_nodes_of(F.col("_at"), tree.levels))).join(periods, ["online", "node"])
        orders = met.groupBy("member_id", "order_id", "scope").agg(F.sum("total").alias("total"))
        totals = orders.groupBy("member_id", "scope").agg(F.count(F.lit(1)).alias("orders"), F.sum("total").alias("sales"), F.min("total").alias("least"), F.max("total").alias("most"))
        none, each = F.lit(None), []
        for measure, number in (("orders", F.col("orders")), ("sales", F.col("sales")), ("basket", F.col("sales") / F.col("orders"))):
            attr = F.concat(F.lit(f"{measure}."), F.col("scope").cast("string"))
            each.append(F.struct(*self._facts(attr, none, number, F.col("least"), F.col("most"))))
        key = F.col("member_id").cast("string").alias("member_id")
        return totals.select(key, F.inline(F.array(*each))).where("number IS NOT NULL")

    def _evaluated(self) -> DataFrame:
        """Ids of rules that no fact tells, each different rule once."""
        docs = [doc for _, doc in self.others.values()]
        shared: dict[str, list[tuple[Filtered, int]]] = {}
        tables = []
        for i, source in enumerate(rule_sources(self.ctx, docs)):
            if isinstance(source, Filtered):
                shared.setdefault(source.name, []).append((source, i))
            else:
                tables.append(source.select("member_id", F.lit(str(i)).alias("text")))
        for uses in shared.values():
            held = F.array_compact(F.array(*[F.when(use.test, F.lit(str(i))) for use, i in uses]))
            tables.append(uses[0][0].base.select(uses[0][0].key.alias("member_id"), F.explode(held).alias("text")))
        found = union_all(*tables).where(F.col("member_id").isNotNull())
        return found.select("member_id", *self._facts(F.lit("rule"), F.col("text"), F.lit(None)))

    # --- lookup

    def _sent(self, rows: Sequence[tuple], kinds: Mapping[str, pa.DataType]) -> DataFrame:
        """A table of the rules, which the driver holds; its size is known, so it is only sent around if small."""
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
        spark = self.ctx.tables("member").sparkSession
        df = spark.createDataFrame(pa.table({n: pa.array(c, t) for (n, t), c in zip(kinds.items(), columns, strict=True)}))
        return F.broadcast(df) if len(rows) <= MOST_SENT else df

    def members(self) -> DataFrame:
        """Rows (member_id, labelId) for every member that a label's fold keeps."""
        by_attr: dict[str, list[Range]] = {}
        for attr, bounds, *_ in self.ranged:
            by_attr.setdefault(attr, []).append(bounds)
        trees = {attr: Tree(ranges) for attr, ranges in by_attr.items()}
        levels = max((t.levels for t in trees.values()), default=0)
        limit = pa.decimal128(38, 10)
        scale = Decimal("1e-10")

        def cut(c: Cut | None) -> tuple:
            return (None, None) if c is None else (c[0].quantize(scale), c[1])

        rows = [(attr, f"={text}", False, *cut(None), *cut(None), label, step) for attr, text, label, step in self.listed]
        for attr, bounds, limits, label, step in self.ranged:
            low, high = limits or (None, None)
            rows += [(attr, node, limits is not None, *cut(low), *cut(high), label, step) for node in trees[attr].nodes(bounds)]
        words = max((len(p) + WORD - 1) // WORD for p in self.programs)
        bit = [1 << (r[-1] % WORD) for r in rows]
        bits = [[b if r[-1] // WORD == w else 0 for r, b in zip(rows, bit, strict=True)] for w in range(words)]
        kinds = {"attr": pa.string(), "key": pa.string(), "limited": pa.bool_(), "low": limit, "low_side": pa.int32(), "high": limit, "high_side": pa.int32(), "label": pa.int32()}
        postings = self._sent([(*r[:-1], *b) for r, b in zip(rows, zip(*bits, strict=True), strict=True)], {**kinds, **{f"_w{w}": pa.int64() for w in range(words)}})

        cuts = F.from_json(F.lit(json.dumps({a: t.rows() for a, t in trees.items()})), f"map<string,array<{CUT}>>")
        facts = union_all(*self.facts())
        ranged = F.when(F.col("number").isNotNull(), F.try_element_at(cuts, F.col("attr")))
        facts = facts.withColumn("_cuts", ranged)
        at = F.struct(F.col("number").alias("v"), F.lit(0).alias("side"))
        facts = facts.withColumn("_at", F.when(F.col("_cuts").isNotNull(), _place(F.col("_cuts"), at, levels)))
        nodes = _nodes_of(F.col("_at"), levels)
        keys = F.when(F.col("text").isNotNull(), F.array(F.concat(F.lit("="), "text"))).when(F.col("_cuts").isNotNull(), nodes)
        met = facts.select("member_id", "attr", "least", "most", F.explode(keys).alias("key")).join(postings, ["attr", "key"])
        bound = lambda v, side: F.struct(F.col(v).alias("v"), side.alias("side"))
        above = F.col("low").isNull() | (bound("low", F.col("low_side")) <= bound("least", F.lit(0)))
        below = F.col("high").isNull() | (bound("high", F.col("high_side")) > bound("most", F.lit(0)))
        met = met.where(~F.col("limited") | (F.col("least").isNotNull() & above & below))

        names = [f"_w{w}" for w in range(words)]
        merged = met.groupBy("label", "member_id").agg(*[F.bit_or(n).alias(n) for n in names])
        programs = self._sent(list(zip(range(len(self.labels)), self.labels, self.programs, strict=True)), {"label": pa.int32(), "labelId": pa.string(), "_ops": pa.string()})
        return merged.join(programs, "label").where(_folded(max(map(len, self.programs)))).select("member_id", "labelId")


def _folded(steps: int) -> Column:
    """Whether the fold of a row's `_ops` over its membership bits holds; grows with the longest fold only."""
    state = F.lit(False)
    for i in range(steps):
        op = F.substring("_ops", i + 1, 1)
        held = F.col(f"_w{i // WORD}").bitwiseAND(F.lit(1 << (i % WORD)).cast("bigint")) != 0
        state = (state | ((op == "o") & held)) & ((op != "a") | held) & ((op != "n") | ~held)
    return state


def indexed_members(ctx: SegmentContext, folds: Mapping[str, Sequence[tuple[Mapping, str]]]) -> DataFrame:
    """(member_id, labelId) of all labels; folds: label -> its rules, with how each combines. No rules: no members."""
    folds = {label: steps for label, steps in folds.items() if steps}
    if not folds:
        return no_ids(ctx).df.withColumn("labelId", F.lit(None).cast("string"))
    return RuleIndex(ctx, folds).members()
