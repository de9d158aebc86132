"""Secret scans over a trigram index."""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import row_key, texts, written
from cartwheel.llm.fixed import literal_rows


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and the least length of one of its groups (0: the whole match)."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


#: Fixed values, in the order in which spans with the same start are listed; the first three are the base kinds.
RULES = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 32),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
BASE = 3
MOST_STRINGS = 24


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Lower-case trigrams that a text must hold to match: any of the sets, all trigrams of a set. None: no such demand.

    Runs of literals, small classes, options and branches are multiplied out to strings while there are few of them;
    everything else ends a run. Of the runs whose strings all have three characters, all must hold.
    """
    demands: list[set[frozenset[str]]] = []

    def close(strings):
        if strings and all(len(s) >= 3 for s in strings):
            demands.append({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})

    def strings_of(node) -> set[str] | None:
        """All strings that the node stands for, or None if they are many."""
        kind, value = str(node[0]), node[1]
        if kind == "LITERAL":
            return {chr(value).lower()}
        if kind == "IN" and all(str(k) == "LITERAL" for k, _ in value):
            return {chr(v).lower() for _, v in value}
        if kind == "SUBPATTERN":
            return finite(value[-1])
        if kind == "BRANCH":
            parts = [finite(branch) for branch in value[1]]
            return None if None in parts else set().union(*parts)
        if kind == "MAX_REPEAT" and value[1] <= 5 and value[0] in (0, value[1]):
            once = finite(value[2])
            if once is None or value[0] != value[1] and value[1] > 1:
                return None
            return once | {""} if value[0] < value[1] else {"".join(p) for p in product(once, repeat=value[1])}
        return None

    def finite(nodes) -> set[str] | None:
        out = {""}
        for node in nodes:
            part = strings_of(node)
            if part is None or len(out) * len(part) > MOST_STRINGS:
                return None
            out = {a + b for a in out for b in part}
        return out

    def walk(nodes):
        run: set[str] = {""}
        for node in nodes:
            part = strings_of(node)
            if part is not None and len(run) * len(part) <= MOST_STRINGS:
                run = {a + b for a in run for b in part}
                continue
            close(run)
            run = {""}
            if part is not None:
                run = set(part)
            elif str(node[0]) == "SUBPATTERN":
                walk(node[1][-1])
            elif str(node[0]) == "MAX_REPEAT" and node[1][0] > 0:
                walk(node[1][2])
        close(run)

    walk(re._parser.parse(pattern))
    if not demands:
        return None
    clauses = {frozenset().union(*choice) for choice in product(*demands)}
    return sorted((c for c in clauses if not any(o < c for o in clauses)), key=sorted)


#: Matches of a text whose places are counted together.
CHUNK = 128


def spans_of(text: Column, rule: Rule, number: int) -> Column:
    """Leftmost matches without overlaps, those too short dropped: structs (start, kind number, end) in code points."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    asked = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    pieces = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), matches.alias("match"), asked.alias("asked"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")

    def width(piece):
        return F.length(piece["gap"]) + F.coalesce(F.length(piece["match"]), F.lit(0))

    def step(state, piece):
        start = state["at"] + F.length(piece["gap"])
        end = state["at"] + width(piece)
        span = F.array(F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end")))
        good = piece["match"].isNotNull() & (F.length(piece["asked"]) >= rule.least)
        return F.struct(end.alias("at"), F.when(good, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    def begin(at):
        return F.struct(at.cast("long").alias("at"), none.alias("spans"))

    def ahead(state, chunk):
        """Where the next chunk starts, and the list of where they all do."""
        total = F.aggregate(chunk, F.lit(0).cast("long"), lambda s, p: s + width(p))
        return F.struct((state["at"] + total).alias("at"), F.concat(state["starts"], F.array(state["at"])).alias("starts"))

    def placed(chunks):
        starts = F.aggregate(
            chunks, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("starts")), ahead, lambda s: s["starts"]
        )
        return F.flatten(F.zip_with(chunks, starts, lambda chunk, at: F.aggregate(chunk, begin(at), step, lambda s: s["spans"])))

    def cut(every):
        last = F.floor((F.size(every) - 1) / CHUNK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(every, i * CHUNK + 1, F.lit(CHUNK)))

    # An array that grows inside an aggregate is copied for each item; in chunks, the copies stay short. Arrays of one
    # item bind what a lambda would evaluate again for each chunk.
    chunks = F.transform(F.array(pieces), cut)
    spans = F.element_at(F.transform(chunks, placed), 1)
    return F.when(F.size(matches) > 0, spans).otherwise(none)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans (start, kind: place of the rule, end), sorted by start and kind, one row per row of ``docs``.

    Matching runs over every whole text; a null text is empty. Positions are code points, the end is exclusive.
    Repeated rows give repeated rows, an empty table none; other columns are ignored.

    1. From each pattern follows a Boolean query of trigrams (``trigram_query``). One scan posts, for each document,
       the queries' trigrams that its lower-cased text holds; rules without a query are matched in that scan.
    2. Posting lists are intersected: a clause holds for the documents in which all its trigrams meet.
    3. Candidates are verified by matching the pattern on the whole text. Only candidates' texts need to move.
    """
    spark = docs.sparkSession
    queries = {n: trigram_query(rule.pattern) for n, rule in enumerate(rules)}
    clauses = [(n, c, sorted(clause)) for n, query in queries.items() if query for c, clause in enumerate(query)]
    needed = sorted({t for _, _, clause in clauses for t in clause})
    source = texts(docs).withColumn("doc", row_key())
    small = F.lower("text")
    held = F.array_compact(F.array(*[F.when(F.contains(small, F.lit(t)), F.lit(i)) for i, t in enumerate(needed)]))
    scanned = [spans_of(F.col("text"), _tight(rule), n) for n, rule in enumerate(rules) if queries[n] is None]
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    base = written(
        source.select("doc_id", "doc", (held if needed else F.array().cast("array<int>")).alias("held"), F.concat(none, *scanned).alias("spans")),
        "secrets-index",
    )
    postings = base.select("doc", F.explode("held").alias("trigram"))
    parts = literal_rows(
        spark,
        [{"trigram": needed.index(t), "rule": n, "clause": c, "bit": 1 << i, "full": (1 << len(clause)) - 1} for n, c, clause in clauses for i, t in enumerate(clause)],
        "trigram int, rule int, clause int, bit bigint, full bigint",
    )
    # As many rows as the rules have trigrams.
    meeting = (
        postings.join(F.broadcast(parts), "trigram")
        .groupBy("doc", "rule", "clause", "full")
        .agg(F.bit_or("bit").alias("bits"))
        .where("bits = full")
    )
    candidates = meeting.groupBy("doc").agg(F.collect_set("rule").alias("rules"))
    verified = written(
        source.select("doc", "text")
        .join(candidates.hint("shuffle_hash"), "doc")
        .select(
            "doc",
            F.concat(
                none,
                *[
                    F.when(F.array_contains("rules", n), spans_of(F.col("text"), rule, n)).otherwise(none)
                    for n, rule in enumerate(rules)
                    if queries[n] is not None
                ],
            ).alias("found"),
        )
        .where(F.size("found") > 0)
        .groupBy("doc")
        .agg(F.first("found").alias("found")),
        "secrets-verified",
    )
    return base.join(verified, "doc", "left").select(
        "doc_id", F.array_sort(F.concat("spans", F.coalesce("found", none))).alias("spans")
    )


def _tight(rule: Rule) -> Rule:
    """For a single repeated class, too short runs needn't be matched at all."""
    single = re.fullmatch(r"(\[[^\]]*\])\+", rule.pattern)
    return Rule(rule.kind, f"{single[1]}{{{rule.least},}}", 0) if single and not rule.group and rule.least else rule


def listed(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of the spans, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
