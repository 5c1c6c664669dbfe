"""Secrets in texts by regular expressions, with a trigram index before them.

Every rule's pattern is turned into a Boolean query over trigrams of the text
in lower case. An inverted index lists, for each trigram of any query, the
documents that hold it; intersecting the lists gives each document the rules it
may match, and only those are run on it. A rule whose pattern forces no trigram
runs on every document.

Everything is built-in functions: no Python runs on the executors.

Nulls count as empty text. Rows that share an id (null ids too) share their
candidate rules; each row is then matched on its own text. Columns other than
those named are not read.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from re import _constants as kinds
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmetrics.llm.common import free_name, text_or_empty

Query = str | bool | tuple[str, tuple]
MOST = 64
FEW = 8
BLOCK = 256


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of `pattern` in which `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The contract's kinds and the forms of well-known tokens. The
# counts in hex and access find what runs of one or more would, less those too
# short: a run's tail is never longer than the run.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
FURTHER = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + FURTHER


# -- from a pattern to a query over trigrams ----------------------------------


def needed(query: Query) -> set[Query]:
    """The conditions of an 'and', or the query itself."""
    return set(query[1]) if isinstance(query, tuple) and query[0] == "and" else {query}


def combined(operation: str, parts: Sequence[Query]) -> Query:
    """'and' or 'or' of queries; True stands for no condition."""
    absorbing = operation == "or"
    if absorbing and True in parts:
        return True
    chosen = {p for p in parts if p is not True}
    if operation == "or":
        # A stricter alternative adds nothing to a looser one.
        chosen = {p for p in chosen if not any(q != p and needed(q) < needed(p) for q in chosen)}
    distinct = tuple(sorted(chosen, key=repr))
    if not distinct:
        return True
    return distinct[0] if len(distinct) == 1 else (operation, distinct)


def of_strings(strings: frozenset[str]) -> Query:
    """That one of the strings occurs."""
    return combined(
        "or", [combined("and", [s[i : i + 3] for i in range(len(s) - 2)] or [True]) for s in strings]
    )


def characters(items) -> frozenset[str] | None:
    """The few characters of a class in lower case, or None."""
    found: set[str] = set()
    for kind, value in items:
        if kind is kinds.LITERAL:
            found.add(chr(value).lower())
        elif kind is kinds.RANGE and value[1] - value[0] < FEW:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return frozenset(found) if len(found) <= FEW else None


def strings_of(items) -> frozenset[str] | None:
    """All strings in lower case that a part of a pattern matches, if few."""
    whole = frozenset([""])
    for kind, value in items:
        if kind is kinds.LITERAL:
            options = frozenset([chr(value).lower()])
        elif kind is kinds.IN:
            options = characters(value)
        elif kind is kinds.SUBPATTERN:
            options = strings_of(value[3])
        elif kind is kinds.BRANCH:
            parts = [strings_of(p) for p in value[1]]
            options = None if None in parts else frozenset().union(*parts)
        elif kind is kinds.MAX_REPEAT and value[1] == 1:
            once = strings_of(value[2])
            options = None if once is None else once | ({""} if value[0] == 0 else set())
        else:
            options = None
        if options is None or len(whole) * len(options) > MOST:
            return None
        whole = frozenset(a + b for a in whole for b in options)
    return whole


def _query(items) -> Query:
    conditions: list[Query] = []
    run = frozenset([""])
    for item in items:
        kind, value = item
        options = strings_of([item])
        if options is not None and len(run) * len(options) <= MOST:
            run = frozenset(a + b for a in run for b in options)
            continue
        conditions.append(of_strings(run))
        run = options or frozenset([""])
        if options is not None:
            continue
        if kind is kinds.SUBPATTERN:
            conditions.append(_query(value[3]))
        elif kind is kinds.BRANCH:
            conditions.append(combined("or", [_query(p) for p in value[1]]))
        elif kind is kinds.MAX_REPEAT and value[0] > 0:
            conditions.append(_query(value[2]))
    return combined("and", [*conditions, of_strings(run)])


def trigram_query(pattern: str) -> Query:
    """What trigrams a text in lower case must hold to match; True if none."""
    return _query(parser.parse(pattern))


def trigrams(query: Query) -> set[str]:
    if isinstance(query, str):
        return {query}
    return set() if query is True else set().union(*map(trigrams, query[1]))


# -- the index and its use ----------------------------------------------------


def postings(docs: DataFrame, rules: Sequence[Rule] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """gram, id: the documents that hold each trigram of the rules' queries."""
    grams = sorted(set().union(*[trigrams(trigram_query(r.pattern)) for r in rules]))
    known = F.array(*[F.lit(g) for g in grams]).cast("array<string>")
    # transform() binds the lowered text once for all trigrams.
    held = F.transform(F.array(F.lower(text_or_empty(text))), lambda t: F.filter(known, lambda g: F.contains(t, g)))[0]
    return docs.select(F.col(doc_id).alias("id"), F.explode(held).alias("gram")).select("gram", "id")


def candidates(index: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """id, kinds: the rules with trigrams that each listed document may match."""
    held = index.groupBy("id").agg(F.collect_set("gram").alias("grams"))

    def met(query: Query) -> Column:
        if isinstance(query, str):
            return F.array_contains("grams", query)
        parts = [met(p) for p in query[1]]
        whole = parts[0]
        for part in parts[1:]:
            whole = (whole & part) if query[0] == "and" else (whole | part)
        return whole

    queries = [(r.kind, trigram_query(r.pattern)) for r in rules]
    named = [F.when(met(q), F.lit(k)) for k, q in queries if q is not True]
    may = F.array_compact(F.array(*named)).cast("array<string>")
    return held.select("id", may.alias("kinds")).filter(F.size("kinds") > 0)


def _walk(steps: Column, at: Column) -> Column:
    """Where the matches lie, from (gap, length, fits) of each in turn."""
    nothing = F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)")

    def step(state: Column, s: Column) -> Column:
        start = state["at"] + s["gap"]
        end = start + s["length"]
        found = F.array(F.struct(start.alias("start"), end.alias("end")))
        found = F.when(s["fits"], F.concat(state["found"], found)).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    return F.aggregate(steps, F.struct(at.alias("at"), nothing.alias("found")), step)


def spans(text: Column, rule: Rule) -> Column:
    """Array of (start, end) in code points. A part of BLOCK matches at a time, so
    that many matches in one text do not take the square of their number."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    lengths = F.zip_with(whole, tested, lambda m, t: F.struct(F.length(m).alias("length"), F.length(t).alias("tested")))
    steps = F.zip_with(
        F.slice(gaps, 1, F.size(whole)),
        lengths,
        lambda g, m: F.struct(
            F.length(g).cast("long").alias("gap"),
            m["length"].cast("long").alias("length"),
            (m["tested"] >= rule.least).alias("fits"),
        ),
    )
    nothing = F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)")
    none = F.struct(F.lit(0).cast("long").alias("at"), nothing.alias("found"))

    def blocks(all_steps: Column) -> Column:
        def block(state: Column, number: Column) -> Column:
            part = _walk(F.slice(all_steps, number * BLOCK + 1, BLOCK), state["at"])
            return F.transform(
                F.array(part), lambda p: F.struct(p["at"].alias("at"), F.concat(state["found"], p["found"]).alias("found"))
            )[0]

        numbers = F.sequence(F.lit(0), F.floor((F.size(all_steps) - 1) / BLOCK).cast("int"))
        return F.when(F.size(all_steps) > 0, F.aggregate(numbers, none, block)["found"]).otherwise(nothing)

    return F.transform(F.array(steps), blocks)[0]


def _naming(rank: int, kind: str) -> Callable[[Column], Column]:
    own = F.lit(rank).alias("rank"), F.lit(kind).alias("kind")
    return lambda s: F.struct(s["start"].alias("start"), *own, s["end"].alias("end"))


def find_secrets(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    keep: Sequence[str] = ("doc_id",),
    doc_id: str = "doc_id",
    text: str = "text",
    into: str = "secrets",
) -> DataFrame:
    """`keep` and `into`: an array of (start, rank, kind, end), by start and then rule. A row per document."""
    ids, may = free_name(docs, "__id"), free_name(docs, "__kinds")
    listed = candidates(postings(docs, rules, doc_id, text), rules).toDF(ids, may)
    joined = docs.join(listed, F.col(doc_id).eqNullSafe(F.col(ids)), "left")
    body = text_or_empty(text)
    empty = F.expr("cast(array() as array<struct<start: bigint, rank: int, kind: string, end: bigint>>)")
    found = []
    for rank, rule in enumerate(rules):
        named = F.transform(spans(body, rule), _naming(rank, rule.kind))
        unindexed = trigram_query(rule.pattern) is True
        try_it = body.rlike(rule.pattern) if unindexed else F.array_contains(may, rule.kind) & body.rlike(rule.pattern)
        found.append(F.when(try_it, named).otherwise(empty))
    return joined.select(*[F.col(f"`{c}`") for c in keep], F.array_sort(F.concat(*found)).alias(into))


def listed(secrets: Column, kinds: Sequence[str] | None = None) -> Column:
    """kind:start:end of the spans, comma-joined."""
    chosen = secrets if kinds is None else F.filter(secrets, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(secrets: Column, kind: str) -> Column:
    return F.size(F.filter(secrets, lambda s: s["kind"] == kind)).cast("long")
