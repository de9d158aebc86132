"""Registered queries of the text operators and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import chat, decontam, exact, licenses, packing, periods, pieces, quality, secrets, shards, simhash, substrings, trie
from cartwheel.llm.common import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def word_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _spans_sql() -> str:
    """One CTE per kind: gaps and matches of each text, running lengths, then the spans that are long enough."""
    parts = []
    for n, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(
            f"""
            SELECT doc_id, {n} AS k, '{rule.kind}' AS kind, upto[2 * i] - length(m[i]) AS s, upto[2 * i] AS e
            FROM (
                SELECT *, unnest(range(1, len(m) + 1)) AS i,
                       list_transform(range(1, 2 * len(m) + 1), lambda j: list_sum(list_transform(z[1 : j], lambda x: length(x)))) AS upto
                FROM (
                    SELECT *, flatten(list_transform(range(1, len(m) + 1), lambda j: [g[j], m[j]])) AS z
                    FROM (
                        SELECT doc_id, string_split_regex(t, '{pattern}') AS g, regexp_extract_all(t, '{pattern}') AS m,
                               regexp_extract_all(t, '{pattern}', {rule.group}) AS asked
                        FROM d WHERE regexp_matches(t, '{pattern}')
                    )
                )
            ) WHERE length(asked[i]) >= {rule.least}
            """
        )
    return " UNION ALL ".join(parts)


@query(
    "op1_secret_scan",
    f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    f AS (SELECT *, concat_ws(':', kind, s, e) AS span FROM ({_spans_sql()}))
    SELECT d.doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
           sha256(coalesce(string_agg(span, ',' ORDER BY s, k) FILTER (k < 3), '')) AS base_sha256,
           coalesce(string_agg(span, ',' ORDER BY s, k), '') AS spans
    FROM d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id
    """,
)
def op1_secret_scan(spark, sf_dir):
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    spans = F.col("spans")

    def of_kind(number):
        return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")

    counts = [of_kind(n).alias(f"n_{rule.kind}") for n, rule in enumerate(secrets.RULES[: secrets.BASE])]
    base = F.filter(spans, lambda s: s["kind"] < secrets.BASE)
    return found.select(
        "doc_id", *counts, F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(spans).alias("spans")
    )


@query(
    "op2_chat_perspectives",
    f"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS place
        FROM conversations
    ), p AS (
        SELECT t.conv_id, speaker, place, role = speaker AS trained, text || '<|end|>' || chr(10) AS body,
               CASE WHEN role = 'system' THEN '<|system|>' WHEN role = speaker THEN '<|assistant|>'
                    ELSE '<|user name=' || role || '|>' END || chr(10) AS header
        FROM t JOIN (SELECT DISTINCT conv_id AS c, role AS speaker FROM t WHERE role <> 'system') ON conv_id IS NOT DISTINCT FROM c
    ), a AS (
        SELECT *, (place - 1) // {chat.TURNS} AS part,
               sum(length(header) + length(body)) OVER (PARTITION BY conv_id, speaker ORDER BY place) AS e
        FROM p
    )
    SELECT conv_id, speaker, CAST(part AS INT) AS part, count(*) AS n_turns,
           CAST(min(e - length(header) - length(body)) AS BIGINT) AS start, CAST(sum(length(header) + length(body)) AS BIGINT) AS n_chars,
           sha256(string_agg(header || body, '' ORDER BY place)) AS text_sha256,
           coalesce(string_agg((e - length(body))::VARCHAR || ':' || e::VARCHAR, ',' ORDER BY place) FILTER (trained), '') AS trained_spans
    FROM a GROUP BY ALL
    """,
)
def op2_chat_perspectives(spark, sf_dir):
    done = chat.render(table(spark, sf_dir, "conversations"))
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return done.select(
        "conv_id", "speaker", "part", "n_turns", "start", F.length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"), F.array_join(spans, ",").alias("trained_spans"),
    )


@query(
    "op3_exact_dedup",
    """
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
    FROM (
        SELECT doc_id, text, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size
        FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
    )
    """,
)
def op3_exact_dedup(spark, sf_dir):
    groups = exact.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def _licenses_sql() -> str:
    """Marks as in ``licenses.marked``; each is doubled, so that neighbouring sentences do not share one."""
    x = licenses
    marks, tag = x.MARKS, x.SPDX_TAG.rstrip(":")
    rules = x.rules_pattern(x.RULES, x.GAP)
    named = "doubled"
    for number, words in sorted(x.SENTENCES.items(), key=lambda s: (-len(s[1]), s[0])):
        pattern = f"[{marks}]" + words.replace(" ", f"(?: |[{marks}]{{2}})") + f"[{marks}]"
        named = f"regexp_replace({named}, '{pattern}', '{x.CUT}={number}{x.CUT}', 'g')"
    names = " ".join(f"WHEN '{''.join(f'{n};' for n in steps)}' THEN '{name}'" for name, steps in x.RULES.items())

    def ids(line):
        return (f"list_transform(list_filter(string_split({line}, '{x.CUT}'), lambda s: s <> ''), "
                "lambda s: CASE WHEN starts_with(s, '=') THEN s[2:] ELSE '-' END)")

    return f"""
    WITH t AS (
        SELECT doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '{x.SPDX_LINE}', '{x.CUT}{tag} \\1{x.CUT}', 'g'),
                                      '({tag} [A-Za-z0-9.-]+)[+]{x.CUT}', '\\1-or-later{x.CUT}', 'g') AS text
        FROM documents
    ), c AS (
        SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(replace(replace(text, '{x.BLANK}', ' '), '{x.LINE}', ' '),
                           '{x.AFTER_STOP}', '\\1{x.CUT}', 'g'), '{x.BLANK_LINES}', '{x.BLANK}\\0', 'g'),
                           '{x.LINE_END}', '{x.LINE}\\1', 'g') AS text
        FROM t
    ), p AS (
        SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(
                           regexp_replace(lower('{x.CUT}' || text || '{x.CUT}'), '[^a-z0-9{marks}]+', ' ', 'g'),
                           ' ?([{marks}]) ?', '\\1', 'g'), '{x.BLANK}+', '{x.BLANK}', 'g'), '[{marks}]{{2,}}', '{x.CUT}', 'g') AS text
        FROM c
    ), d AS (
        SELECT doc_id, regexp_replace(text, '[{marks}]', '\\0\\0', 'g') AS doubled FROM p
    ), m AS (
        SELECT doc_id, replace(regexp_replace(regexp_replace(regexp_replace(named, '[{marks}]*{x.CUT}[{marks}]*', '{x.CUT}', 'g'),
                           '{x.BLANK}+', '{x.BLANK}', 'g'), '{x.LINE}+', '{x.LINE}', 'g'), '{x.BLANK}', ' ') AS line
        FROM (SELECT doc_id, {named} AS named FROM d)
    ), l AS (
        SELECT doc_id, {ids(f"replace(line, '{x.LINE}', '{x.CUT}')")} AS ids,
               array_to_string({ids(f"replace(line, '{x.LINE}', ' ')")}, ';') || ';' AS line
        FROM m
    ), r AS (
        SELECT doc_id, ids, list_transform(regexp_extract_all(line, '\\b(?:{rules})'), lambda s: CASE replace(s, '-;', '') {names} END) AS held
        FROM l
    )
    SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, array_to_string(list_filter(ids, lambda s: s <> '-'), ',') AS known,
           array_to_string(list_transform(list_sort(list_distinct(held)),
                           lambda n: n || ':' || len(list_filter(held, lambda h: h = n))), ',') AS licences
    FROM r
    """


@query("op4_license_scan", _licenses_sql())
def op4_license_scan(spark, sf_dir):
    found = licenses.licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_sentences", F.array_join("known", ",").alias("known"), F.array_join("licences", ",").alias("licences")
    )


@query(
    "op5_benchmark_decontamination",
    r"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w
        FROM documents
    ), b AS (
        SELECT item_id, w, least(13, len(w)) AS k FROM (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w
            FROM benchmark
        ) WHERE len(w) > 0
    ), bw AS (
        SELECT DISTINCT item_id, k, array_to_string(w[s : s + k - 1], ' ') AS g
        FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS s FROM b)
    ), dw AS (
        SELECT doc_id, s, k, array_to_string(w[s : s + k - 1], ' ') AS g
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM b))
    ), m AS (
        SELECT dw.doc_id, dw.s, dw.k, bw.item_id FROM dw JOIN bw USING (k, g)
    ), h AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM m) GROUP BY doc_id
    ), i AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id
    )
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
    """,
)
def op5_benchmark_decontamination(spark, sf_dir):
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontam.is_contaminated().alias("contaminated"),
    )


@query("op6_simhash_near_dedup")
def op6_simhash_near_dedup(spark, sf_dir):
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id")
    )


@query("op7_shard_shuffle")
def op7_shard_shuffle(spark, sf_dir):
    dealt = shards.shuffle_into_shards(table(spark, sf_dir, "documents"))
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op8_suffix_dedup")
def op8_suffix_dedup(spark, sf_dir):
    return substrings.drop_repeats(table(spark, sf_dir, "documents"))


@query("op9_quality_classifier")
def op9_quality_classifier(spark, sf_dir):
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_sentencepiece")
def op10_sentencepiece(spark, sf_dir):
    done = pieces.encode_decode(table(spark, sf_dir, "documents"), model_path())
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Documents whose number's checksum ends in 0 repeat a stretch of their own words up to their end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = "array(filter(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> ''))"
    # The lambda over one-item arrays binds the words once; a column would be split again for each word.
    periodic = F.expr(
        f"transform({words}, ws -> array_join(transform(ws, (w, i) -> CASE WHEN i < g % size(ws) THEN w ELSE "
        "ws[int(g % size(ws) + (i - g % size(ws)) % (1 + (size(ws) - g % size(ws)) div (3 + g % 8)))] END), ' '))[0]"
    )
    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", h.alias("h"), F.expr("h div 10").alias("g"))
    return placed.select("doc_id", F.when(F.col("h") % 10 == 0, periodic).otherwise(F.col("text")).alias("text"))


def periodic_runs(docs: DataFrame) -> DataFrame:
    found = periods.find_runs(with_planted_periods(docs)).withColumn("best", periods.best_run())
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op11_periodic_runs")
def op11_periodic_runs(spark, sf_dir):
    return periodic_runs(table(spark, sf_dir, "documents"))


@query("op12_best_fit_packing")
def op12_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), word_tokenizer_path()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


CRC32_SQL = """list_reduce(list_concat([4294967295], list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i, 1)))),
        lambda x, y: list_reduce(list_concat([xor(x, y)], [0, 0, 0, 0, 0, 0, 0, 0]),
                                 lambda u, v: CASE WHEN u & 1 = 1 THEN xor(u >> 1, 3988292384) ELSE u >> 1 END))"""


@query(
    "op13_conversation_trie",
    f"""
    WITH t AS (
        SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS rn
        FROM conversations WHERE conv_id IS NOT NULL
    ), l AS (
        SELECT *, xor({CRC32_SQL}, 4294967295) % 4 AS h
        FROM (SELECT c, list({{'r': r, 'x': x}} ORDER BY rn) AS turns FROM t GROUP BY c)
    ), b AS (
        SELECT l.c, list_concat(coalesce(p.turns[1 : l.h], []), l.turns[l.h + 1 :]) AS s FROM l LEFT JOIN l p ON p.c = l.c - l.c % 20
    ), m AS (
        SELECT c, d, s[1 : d] AS k, len(s) = d AS here FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM b)
    ), n AS (
        SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (here), '')) AS ends_sha256,
               (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(k[d].x, '[^\\x{{20}}\\x{{09}}-\\x{{0D}}]+')) END AS own
        FROM m GROUP BY k, d
    ), e AS (
        SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM n q WHERE q.d = n.d + 1 AND q.k[1 : n.d] = n.k) AS n_children
        FROM n LEFT JOIN n p ON p.d = n.d - 1 AND p.k = n.k[1 : n.d - 1]
    ), a AS (
        SELECT k[1 : j] AS k, j AS d, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(own) AS BIGINT) AS saved_tokens
        FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM e) GROUP BY 1, 2
    )
    SELECT conv_id, e.d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM e JOIN a ON e.d = a.d AND e.k = a.k
    """,
)
def op13_conversation_trie(spark, sf_dir):
    return conversation_trie(table(spark, sf_dir, "conversations"))


def conversation_trie(turns: DataFrame) -> DataFrame:
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    placed = written(trie.clean_turns(turns), "trie-placed")
    return trie.prefix_trie(*trie.with_shared_heads(placed, head, F.col("conv_id") - F.col("conv_id") % 20, 3))
