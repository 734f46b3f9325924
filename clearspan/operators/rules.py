"""Fee rules: every transaction gets the first rule whose conditions all hold.

A rule names a scope (jurisdiction, for one brand also a rate code), a number that
orders it, and condition texts such as ``A,100``, ``NOT:5411,6011``,
``0-100,150``, ``>0``, ``BETWEEN 0 AND 10`` or ``Space,1``. An empty text sets no
condition.

Rules are looked up in an index: for each scope, condition column and value the bitmap of
the rules that the value pleases. The bitmaps of a row's values are combined by AND, and the first
bit left is the rule. One form serves any number of rules; a row costs a lookup for each condition
column, whatever the number of rules, and is never shuffled.
"""

from __future__ import annotations

import datetime as dt
import itertools
import operator
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from clearspan.functions.text import text_or_blank
from clearspan.operators.skew import bounded_rows
from clearspan.operators.stages import end_generated_code

#: Word standing for a missing value in data and in rules.
BLANK = "BLANK"
#: Prefix of a negated condition.
NOT = "NOT:"

MEMBER, SPACE, RANGE, COMPARE, AMOUNT = "member", "space", "range", "compare", "amount"
MAX_RULES = 50_000
#: Number standing for "no rule".
NO_RULE = 0
#: Rules of one scope that one pass looks at.
RULES_PER_PASS = 1024
#: Rules in one word of a bitmap; words stay below the sign bit.
BITS = 62
#: Bytes of the index that may be broadcast; a larger rule book is refused.
MAX_INDEX_BYTES = 64 << 20
#: Lookups compiled into one generated method.
JOINS_PER_METHOD = 9
#: Steps of the search for a number's stretch compiled into one generated method.
STEPS_PER_METHOD = 24


@dataclass
class Condition:
    """Parsed condition text."""

    negated: bool = False
    values: list[str] = field(default_factory=list)
    ranges: list[tuple[int, int]] = field(default_factory=list)
    bounds: list[tuple[str, float]] = field(default_factory=list)
    never: bool = False


@dataclass(frozen=True)
class RuleBook:
    """How a rule table is read.

    ``scope`` maps row columns to rule columns; ``kinds`` gives the kind of every
    condition column; ``amount_currency`` names the rule column holding the
    currency of ``amount`` conditions. The row column of a condition is its name
    after ``row_prefix``.
    """

    scope: Mapping[str, str]
    kinds: Mapping[str, str]
    rule_id: str = "rule_id"
    amount_currency: str | None = None
    valid_from: str = "valid_from"
    valid_until: str = "valid_until"
    row_prefix: str = ""


def parse_condition(kind: str, text: str | None) -> Condition | None:
    """Read a condition text; null when it sets no condition.

    A text that cannot be read becomes a condition that never holds.
    """
    if text is None or str(text).replace(" ", "").lower() in ("", "none", "nan"):
        return None
    body = str(text).replace(" ", "")
    try:
        if kind in (COMPARE, AMOUNT):
            return _parse_comparison(body)
        negated = NOT in body.upper()
        if negated:
            body = re.sub(NOT, "", body, flags=re.IGNORECASE)
        if kind == SPACE:
            values = re.sub("space", " ", body, flags=re.IGNORECASE).upper().split(",")
            return Condition(negated, values=values)
        items = body.split(",")
        if kind == RANGE and (len(items) > 1 or "-" in body):
            return Condition(negated, ranges=[_parse_range(i) for i in items])
        if len(items) == 1 and "." in body and body.replace(".", "").isdigit():
            items = [str(int(float(body)))]
        return Condition(negated, values=items if negated else [i.upper() for i in items])
    except ValueError:
        return Condition(never=True)


def _parse_range(item: str) -> tuple[int, int]:
    low, dash, high = item.partition("-")
    return (int(low), int(high)) if dash else (int(item), int(item))


def _parse_comparison(body: str) -> Condition:
    between = re.fullmatch(r"between(-?\d+)and(-?\d+)", body.lower())
    if between:
        return Condition(bounds=[(">=", float(between[1])), ("<=", float(between[2]))])
    bounds = []
    for part in body.split(","):
        found = re.fullmatch(r"(<=|>=|==|=|<|>)?(-?\d+(?:\.\d+)?)", part)
        if not found:
            raise ValueError(part)
        bounds.append(("=" if found[1] in (None, "==") else found[1], float(found[2])))
    return Condition(bounds=bounds)


def seen_value(kind: str, c: Column) -> Column:
    """What a condition of a kind looks at: a number, the raw word, or the trimmed word."""
    if kind == AMOUNT:
        return c.cast("double")
    word = text_or_blank(c)
    if kind == COMPARE:
        return F.when(word != BLANK, word.try_cast("double"))
    if kind == SPACE:
        return word
    trimmed = F.trim(word)
    return trimmed if kind == RANGE else F.when(trimmed == "", BLANK).otherwise(trimmed)


def load_rules(rules: DataFrame, book: RuleBook) -> list[dict]:
    """Rules as dictionaries with parsed conditions, in numeric order of their id."""
    rows = [r.asDict() for r in bounded_rows(rules, MAX_RULES, "rule table")]
    rows.sort(key=lambda r: ([str(r[c]) for c in book.scope.values()], float(r[book.rule_id])))
    for number, row in enumerate(rows, start=1):
        row["_rule_no"] = number
        row["_conds"] = {
            c: cond
            for c, kind in book.kinds.items()
            if c in row and (cond := parse_condition(kind, row[c])) is not None
        }
    return rows


def amount_currencies(rules: DataFrame, book: RuleBook) -> list[str]:
    """Currencies named by amount conditions."""
    if not book.amount_currency:
        return []
    found = rules.select(book.amount_currency).where(F.col(book.amount_currency).isNotNull()).distinct()
    return sorted(r[0] for r in bounded_rows(found, 1000, "rule currencies"))


def unreadable_conditions(rules: DataFrame, book: RuleBook) -> list[tuple]:
    """Rule id and column of every condition text that cannot be read."""
    return [
        (row[book.rule_id], column)
        for row in load_rules(rules, book)
        for column, cond in row["_conds"].items()
        if cond.never
    ]


@dataclass(frozen=True)
class Probe:
    """What rules ask of one column: its word, its whole number, its number, or the row's day."""

    look: str
    column: str | None = None
    currency: str | None = None


@dataclass
class Wish:
    """What one rule asks of a probe; unlisted and unreadable values only please negated wishes."""

    values: frozenset[str] | None = None
    ranges: tuple[tuple[int, int], ...] = ()
    bounds: tuple[tuple[str, float], ...] = ()
    negated: bool = False

    def holds(self, x: object) -> bool:
        """Whether a word, or a number between the edges, pleases."""
        if self.values is not None:
            return (x in self.values) != self.negated
        if self.bounds:
            return all(_OPERATORS[op](x, bound) for op, bound in self.bounds)
        return any(low <= x <= high for low, high in self.ranges) != self.negated

    def edges(self) -> set:
        """Numbers at which the answer may change."""
        if self.bounds:
            return {x for _, x in self.bounds}
        return {e for low, high in self.ranges for e in (low, high + 1)}


_OPERATORS = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "=": operator.eq}
WORD, WHOLE, REAL, DAY = "word", "whole", "real", "day"
#: First and last day that a rule without a limit on that side counts from and to.
_EPOCH = dt.date(1970, 1, 1)


def _wishes(rule: dict, book: RuleBook, dated: bool, today: dt.date) -> dict[Probe, Wish] | None:
    """The rule's conditions by probe; null for a rule that can never hold."""
    out: dict[Probe, Wish] = {}
    for column, cond in rule["_conds"].items():
        kind = book.kinds[column]
        currency = rule.get(book.amount_currency) if kind == AMOUNT else None
        if cond.never or (kind == AMOUNT and not currency):
            return None
        if kind in (COMPARE, AMOUNT):
            out[Probe(REAL, column, currency)] = Wish(bounds=tuple(cond.bounds))
        elif cond.ranges:
            out[Probe(WHOLE, column)] = Wish(ranges=tuple(cond.ranges), negated=cond.negated)
        else:
            out[Probe(WORD, column)] = Wish(values=frozenset(cond.values), negated=cond.negated)
    if dated:
        first, last = (None if rule[c] is None else dt.date.fromisoformat(str(rule[c])[:10]) for c in (book.valid_from, book.valid_until))
        if first is None:
            return None
        out[Probe(DAY)] = Wish(ranges=(((first - _EPOCH).days, ((last or today) - _EPOCH).days),))
    return out


@dataclass
class RuleIndex:
    """Bitmaps of the rules of each scope, ``words`` integers of ``BITS`` rules each.

    Rules of a scope stand in order, so the first bit left is the first rule. A scope with more rules than
    one pass holds has several blocks, which are looked at one after another.
    """

    words: int
    probes: list[Probe]
    #: (pass, scope values, block, number of the rule before the first, words of all rules and of each probe's default)
    blocks: list[tuple]
    #: (probe and block number, edges)
    edges: dict[tuple[int, int], list]
    #: for each probe (value or number of the stretch, block, words)
    entries: dict[int, list[tuple]]

    @property
    def passes(self) -> int:
        return max((b[0] for b in self.blocks), default=-1) + 1


def _packed(bits: Iterable[bool], words: int) -> tuple[int, ...]:
    out = [0] * words
    for i, bit in enumerate(bits):
        out[i // BITS] |= bit << (i % BITS)
    return tuple(out)


def rule_index(loaded: list[dict], book: RuleBook, dated: bool, today: dt.date, per_pass: int = RULES_PER_PASS) -> RuleIndex:
    """For every scope, probe and value the bitmap of the rules that the value pleases.

    Only values that rules name, and the stretches between the numbers they name, have entries; all others
    share a default. The index grows with what the rule texts hold, not with the product of rules and values.
    """
    scopes: dict[tuple, list[dict]] = {}
    for rule in loaded:
        scopes.setdefault(tuple(str(rule[c]) for c in book.scope.values()), []).append(rule)
    words = -(-min(per_pass, max(map(len, scopes.values()), default=1)) // BITS)
    position: dict[Probe, int] = {}
    index = RuleIndex(words, [], [], {}, {})
    size = 0
    for scope, rules in scopes.items():
        for start in range(0, len(rules), per_pass):
            part = rules[start : start + per_pass]
            wishes = [_wishes(r, book, dated, today) for r in part]
            block = len(index.blocks)
            used = dict.fromkeys(p for w in wishes if w for p in w)
            defaults = {}
            for probe in used:
                number = position.setdefault(probe, len(position))
                mine = [None if w is None else w.get(probe) for w in wishes]
                defaults[number] = _packed((w is None or w.negated for w in mine), words)
                if probe.look == WORD:
                    values = {str(v): v for w in mine if w for v in w.values}
                else:
                    edges = sorted({e for w in mine if w for e in w.edges()})
                    index.edges[number, block] = edges
                    values = dict(enumerate(_stretches(edges, probe.look == REAL)))
                entries = index.entries.setdefault(number, [])
                for key, value in values.items():
                    entries.append((key, block, *_packed((w is None or w.holds(value) for w in mine), words)))
                size += len(values) * (32 + 8 * words)
            if size > MAX_INDEX_BYTES:
                raise ValueError(f"rule index exceeds {MAX_INDEX_BYTES} bytes")
            index.blocks.append((start // per_pass, scope, block, part[0]["_rule_no"] - 1, _packed((w is not None for w in wishes), words), defaults))
    index.probes = list(position)
    return index


def _stretches(edges: list, points: bool) -> list:
    """A number of every stretch between the edges, from below the first on.

    An edge opens a stretch; with ``points`` it is one by itself, before the open stretch above it.
    """
    if not edges:
        return [0]
    if not points:
        return [edges[0] - 1, *edges]
    inner = [x for a, b in itertools.pairwise(edges) for x in (a, (a + b) / 2)]
    return [edges[0] - 1.0, *inner, edges[-1], edges[-1] + 1.0]


def _with_stretches(rows: DataFrame, steps: Mapping[int, int], points: Mapping[int, bool], seen: Mapping[int, str]) -> DataFrame:
    """Replace the value of each numeric probe by the number of the stretch it lies in, null without a value or edges.

    The search halves the edges, one step of all probes in one projection: a higher-order function would be interpreted row by row.
    """
    value, edges, at = ({i: F.col(f"{name}{i}") for i in steps} for name in ("_value", "_edges", "_at"))
    rows = rows.withColumnsRenamed({seen[i]: f"_value{i}" for i in steps}).withColumns({f"_at{i}": F.lit(0) for i in steps})
    done = 0
    for k in reversed(range(max(steps.values(), default=0))):
        now = [i for i in steps if steps[i] > k]
        if done and done + len(now) > STEPS_PER_METHOD:
            rows, done = end_generated_code(rows), 0
        done += len(now)
        far = {i: at[i] + (1 << k) for i in now}
        rows = rows.withColumns(
            # beyond the last edge there is none to compare with
            {f"_at{i}": F.when(F.get(edges[i], far[i] - 1) <= value[i], far[i]).otherwise(at[i]) for i in now}
        )
    found = {i: at[i] for i in steps}
    for i in steps:
        if points[i]:
            found[i] = 2 * at[i] - F.when(F.coalesce(F.get(edges[i], at[i] - 1) == value[i], F.lit(False)), 1).otherwise(0)
    rows = rows.withColumns({seen[i]: F.when(value[i].isNotNull() & edges[i].isNotNull(), found[i]) for i in steps})
    return rows.drop(*[f"{name}{i}" for i in steps for name in ("_value", "_edges", "_at")])


def _probe_value(probe: Probe, book: RuleBook, columns: Sequence[str], on_date: Column | None) -> Column:
    if probe.look == DAY:
        return F.date_diff(on_date, F.lit(_EPOCH))
    source = f"{book.row_prefix}{probe.column}" + (f"_{probe.currency.lower()}" if probe.currency else "")
    given = F.col(f"`{source}`") if source in columns else F.lit(None).cast("string")
    seen = seen_value(book.kinds[probe.column], given)
    # whole numbers written without leading zeros, as a listed value would be
    return F.when(seen.rlike("^(0|[1-9][0-9]{0,17})$"), seen.try_cast("bigint")) if probe.look == WHOLE else seen


def assign_first_rule(
    df: DataFrame,
    rules: DataFrame,
    book: RuleBook,
    payload: Sequence[str],
    on_date: Column | None = None,
    per_pass: int = RULES_PER_PASS,
) -> DataFrame:
    """Left join every row to its first matching rule, adding the ``payload`` columns.

    ``on_date`` limits rules to those in force on the row's day. Rows are not shuffled and keep their
    number: all tables they meet are broadcast, and their size is bounded while the index is built.
    """
    loaded = load_rules(rules, book)
    today = df.sparkSession.range(1).select(F.current_date()).first()[0]
    index = rule_index(loaded, book, on_date is not None, today, per_pass)
    seen = {i: f"_seen{i}" for i in range(len(index.probes))}
    rows = df.select("*", *[_probe_value(p, book, df.columns, on_date).alias(seen[i]) for i, p in enumerate(index.probes)])
    rows = end_generated_code(rows.withColumn("_rule_no", F.lit(NO_RULE)))
    for n in range(index.passes):
        rows = _one_pass(rows, rules, index, n, book, seen)
    table = F.broadcast(_rule_table(rules, loaded, payload))
    return rows.join(table, "_rule_no", "left").select(*df.columns, *payload)


def _one_pass(rows: DataFrame, rules: DataFrame, index: RuleIndex, n: int, book: RuleBook, seen: Mapping[int, str]) -> DataFrame:
    """Look rows without a rule up in the ``n``-th block of their scope."""
    blocks = [b for b in index.blocks if b[0] == n]
    used = sorted({i for b in blocks for i in b[5]})
    every = tuple([(1 << BITS) - 1] * index.words)
    kinds = {WHOLE: T.LongType(), DAY: T.LongType(), REAL: T.DoubleType()}
    numeric = [i for i in used if index.probes[i].look != WORD]
    fields = [T.StructField(f"_scope{k}", T.StringType()) for k in range(len(book.scope))]
    fields += [T.StructField("_block", T.IntegerType()), T.StructField("_before", T.IntegerType())]
    # the words of all rules, then those of each probe's default: one column to carry
    fields += [T.StructField("_all", T.ArrayType(T.LongType())), T.StructField("_else", T.ArrayType(T.LongType()))]
    fields += [T.StructField(f"_edges{i}", T.ArrayType(kinds[index.probes[i].look])) for i in numeric]
    data = [
        (*scope, block, before, list(all_), [x for i in used for x in defaults.get(i, every)], *[index.edges.get((i, block)) for i in numeric])
        for _, scope, block, before, all_, defaults in blocks
    ]
    table = local_table(rules, fields, data)
    here = (F.col("_rule_no") == NO_RULE) & reduce(
        lambda a, b: a & b, [text_or_blank(F.col(f"`{c}`")) == F.col(f"_scope{k}") for k, c in enumerate(book.scope)]
    )
    known = rows.columns
    rows = rows.join(F.broadcast(table), here, "left").drop(*[f"_scope{k}" for k in range(len(book.scope))])
    rows = rows.withColumns({f"_key{i}": F.col(seen[i]) for i in used})
    steps = {i: max(len(e) for (p, _), e in index.edges.items() if p == i).bit_length() for i in numeric}
    rows = _with_stretches(rows, steps, {i: index.probes[i].look == REAL for i in numeric}, {i: f"_key{i}" for i in numeric})
    rows = rows.withColumns({f"_left{w}": F.col("_all")[w] for w in range(index.words)}).drop("_all")
    rows = end_generated_code(rows)
    for at, i in enumerate(used):
        key = T.StringType() if index.probes[i].look == WORD else T.IntegerType()
        hits = [T.StructField("_at", key), T.StructField("_of", T.IntegerType()), *[T.StructField(f"_hit{w}", T.LongType()) for w in range(index.words)]]
        mine = F.broadcast(local_table(rules, hits, index.entries[i]))
        rows = rows.join(mine, (F.col(f"_key{i}") == F.col("_at")) & (F.col("_block") == F.col("_of")), "left")
        # what a probe leaves is taken at once, so its words are not carried on
        left = {
            f"_left{w}": F.col(f"_left{w}").bitwiseAND(F.coalesce(F.col(f"_hit{w}"), F.col("_else")[at * index.words + w])) for w in range(index.words)
        }
        rows = rows.withColumns(left).drop("_at", "_of", f"_key{i}", *[f"_hit{w}" for w in range(index.words)])
        if at % JOINS_PER_METHOD == JOINS_PER_METHOD - 1:
            rows = end_generated_code(rows)
    rows = end_generated_code(rows.select(*known, "_before", *[f"_left{w}" for w in range(index.words)]))
    found = None
    for w in range(index.words):
        word = F.col(f"_left{w}")
        number = F.col("_before") + BITS * w + 1 + F.bit_count(F.bitwise_not(word).bitwiseAND(word - 1))
        found = F.when(word != 0, number) if found is None else found.when(word != 0, number)
    return rows.select(*[c for c in known if c != "_rule_no"], F.coalesce(found, F.col("_rule_no")).alias("_rule_no"))


def _rule_table(rules: DataFrame, loaded: list[dict], columns: Sequence[str]) -> DataFrame:
    fields = [T.StructField("_rule_no", T.IntegerType())]
    fields += [T.StructField(c, rules.schema[c].dataType) for c in columns]
    none = (NO_RULE, *[None for _ in columns])
    return local_table(rules, fields, [none] + [(r["_rule_no"], *[r[c] for c in columns]) for r in loaded])


def local_table(like: DataFrame, fields: list[T.StructField], rows: list[tuple]) -> DataFrame:
    """Small driver-side rows as a table Spark knows the size of."""
    schema = T.StructType(fields)
    columns = [pa.array(list(c), to_arrow_type(f.dataType)) for c, f in zip(zip(*rows), fields)]
    if not rows:
        columns = [pa.array([], to_arrow_type(f.dataType)) for f in fields]
    table = pa.Table.from_arrays(columns, names=[f.name for f in fields])
    return like.sparkSession.createDataFrame(table, schema)


def rule_sheet_problems(
    sheet: DataFrame, required: Sequence[str], numeric: Sequence[str]
) -> DataFrame:
    """One row: how many mandatory fields are missing and numeric fields unreadable.

    A sheet with any problem is rejected as a whole (see :func:`accept_rule_sheet`).
    """
    missing = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"missing_{c}") for c in required]
    unreadable = [
        F.count(F.when(F.col(c).isNotNull() & F.col(c).cast("string").try_cast("double").isNull(), 1)).alias(
            f"unreadable_{c}"
        )
        for c in numeric
    ]
    return sheet.agg(*missing, *unreadable)


def accept_rule_sheet(sheet: DataFrame, required: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """The sheet itself, or an error naming the failing fields."""
    found = rule_sheet_problems(sheet, required, numeric).collect()[0].asDict()
    bad = sorted(k for k, n in found.items() if n)
    if bad:
        raise ValueError("rule sheet rejected: " + ", ".join(bad))
    return sheet


def derive_bitmap_rule_fields(sheet: DataFrame) -> DataFrame:
    """Category from its two parts (null when one is missing) and the default tier."""
    return sheet.withColumn(
        "fee_category", F.concat(F.col("category"), F.lit(" "), F.col("payment_product"))
    ).withColumn("fee_tier", F.coalesce(F.col("fee_tier"), F.lit("S/I")))


def same_columns(sheet: DataFrame, table: DataFrame) -> bool:
    """Whether a sheet still has the columns of the stored rule table."""
    return sorted(sheet.columns) == sorted(table.columns)


def merge_rules(current: DataFrame, sheet: DataFrame, key: Sequence[str]) -> DataFrame:
    """Old rules the sheet does not name, old rules it does, and its new rules."""
    names = sheet.select(*key).distinct()
    known = current.select(*key).distinct()
    gone = current.join(names, list(key), "left_anti")
    kept = current.join(names, list(key), "left_semi")
    new = sheet.join(known, list(key), "left_anti")
    return gone.unionByName(kept).unionByName(new, allowMissingColumns=True)
