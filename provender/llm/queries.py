"""The queries of this subpackage and the SQL that some are checked against."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provender.llm import (
    embeddings,
    languages,
    licenses,
    mixing,
    packing,
    quality,
    quoting,
    rebuilding,
    secrets,
    simhash,
    token_files,
    topk,
    trie,
    whitening,
)
from provender.plans.catalog import Catalog
from provender.plans.tables import table
from provender.session import scratch_dir

_catalog = Catalog()
QUERIES, SQL = _catalog.queries, _catalog.sql

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
rows_ AS (
  SELECT *, CASE WHEN len(bin(size)) < 3 THEN 4 * len(bin(size))
                 ELSE 4 * len(bin(size)) + ((size >> (len(bin(size)) - 3)::BIGINT) & 3) END AS class_,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 4))::BIGINT % 64 AS salt
  FROM sized),
sources AS (
  SELECT k, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY k = '', k) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
  FROM sized GROUP BY k),
stops AS (
  SELECT *, 2.0::DOUBLE * source_size AS room, 2.0::DOUBLE * source_size / weight AS stop,
         1.5::DOUBLE * sum(source_size) OVER () AS goal FROM sources),
levels AS (
  SELECT *, row_number() OVER w AS place,
         (goal - coalesce(sum(room) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           AS level_
  FROM stops WINDOW w AS (ORDER BY stop, k = '', k)),
planned AS (
  SELECT k, source_size,
         least(room, weight * (SELECT coalesce(arg_min(level_, place), 'inf'::DOUBLE) FROM levels WHERE level_ <= stop)) AS target
  FROM levels),
placed AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
         ('0x' || substr(md5('mix' || k), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u,
         row_number() OVER (PARTITION BY k ORDER BY class_, salt, size, doc_id)::DOUBLE AS place
  FROM rows_ JOIN planned USING (k))
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (floor(rate * place + u) - floor(rate * (place - 1) + u))::BIGINT AS copies,
       (size * (floor(rate * place + u) - floor(rate * (place - 1) + u)))::BIGINT AS taken
FROM placed
"""


def _secrets_sql() -> str:
    """Places of matches from the text between them, rule by rule."""
    def spans(rank: int, rule: secrets.Rule) -> str:
        pattern = rule.pattern.replace("'", "''")
        return f"""
  SELECT row_, {rank} AS rank, '{rule.kind}' AS kind, start_, start_ + len(whole) AS end_ FROM (
    SELECT row_, whole, part,
           sum(len(gap)) OVER w + coalesce(sum(len(whole)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS start_
    FROM (SELECT row_, unnest(string_split_regex(t, '{pattern}')) AS gap,
                 unnest(regexp_extract_all(t, '{pattern}', 0)) AS whole,
                 unnest(regexp_extract_all(t, '{pattern}', {rule.group})) AS part,
                 unnest(range(len(regexp_extract_all(t, '{pattern}', 0)))) AS i
          FROM texts WHERE regexp_matches(t, '{pattern}'))
    WHERE whole IS NOT NULL WINDOW w AS (PARTITION BY row_ ORDER BY i))
  WHERE len(part) >= {rule.least}"""

    every = " UNION ALL ".join(spans(rank, rule) for rank, rule in enumerate(secrets.RULES))
    base = f"rank < {len(secrets.BASE_RULES)}"
    joined = "string_agg(kind || ':' || start_ || ':' || end_, ',' ORDER BY start_, rank)"
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE_RULES)
    return f"""
WITH texts AS (SELECT row_number() OVER () AS row_, doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({every})
SELECT doc_id, {counts}, sha256(coalesce({joined} FILTER ({base}), '')) AS base_sha256,
       coalesce({joined} FILTER (kind IS NOT NULL), '') AS spans
FROM texts LEFT JOIN spans USING (row_) GROUP BY row_, doc_id"""


SECRETS_SQL = _secrets_sql()

TOP_K_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row_, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.row_ AS ask, q.vec_id AS query_id, c.vec_id, c.row_,
         list_inner_product(q.x::DOUBLE[], c.x::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.row_ <> c.row_ WHERE q.vec_id % 100 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY ask ORDER BY score DESC, vec_id, row_)::INTEGER AS rank FROM scored)
WHERE rank <= 10
"""

QUOTES_SQL = r"""
WITH RECURSIVE messages AS (
  SELECT row_number() OVER () AS rid, conv_id, turn, role,
         string_split_regex(coalesce(text, ''), '\r?\n') AS lines FROM conversations),
lines AS (
  SELECT rid, conv_id, turn, i, regexp_replace(line, '^[ \t]*(?:>[ \t]?)+', '') AS rest,
         len(regexp_replace(regexp_extract(line, '^[ \t]*(?:>[ \t]?)+', 0), '[^>]', '', 'g')) AS level
  FROM (SELECT rid, conv_id, turn, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM messages)),
cut AS (
  SELECT *, coalesce(level <> lag(level) OVER w OR (trim(rest) = '') <> (trim(lag(rest) OVER w) = ''), true) AS new_run
  FROM lines WINDOW w AS (PARTITION BY rid ORDER BY i)),
runs AS (
  SELECT *, sum(new_run::INT) OVER (PARTITION BY rid ORDER BY i) AS run FROM cut),
passages AS (
  SELECT rid, conv_id, turn, level,
         lower(trim(regexp_replace(string_agg(rest, chr(10) ORDER BY i), '\s+', ' ', 'g'))) AS plain
  FROM runs WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY rid, conv_id, turn, level, run),
origins AS (SELECT conv_id, plain, min(turn) AS origin FROM passages WHERE level = 0 AND plain <> '' GROUP BY ALL),
answers AS (
  SELECT rid, count(*) AS quotes, count(*) FILTER (origin < p.turn) AS linked,
         max({'l': -level, 'o': origin}) FILTER (origin < p.turn) AS best
  FROM passages p LEFT JOIN origins USING (conv_id, plain) WHERE level > 0 AND plain <> '' GROUP BY rid),
replies AS (
  SELECT rid, conv_id, turn, role, coalesce(quotes, 0) AS quotes, coalesce(linked, 0) AS linked, best.o AS reply_to
  FROM messages LEFT JOIN answers USING (rid)),
ups AS (SELECT conv_id, turn, max(reply_to) AS up FROM replies GROUP BY ALL),
walk AS (
  SELECT conv_id, turn, turn AS at_ FROM ups
  UNION ALL SELECT w.conv_id, w.turn, u.up FROM walk w JOIN ups u ON u.conv_id = w.conv_id AND u.turn = w.at_
  WHERE u.up IS NOT NULL),
roots AS (SELECT conv_id, turn, min(at_) AS thread FROM walk GROUP BY ALL),
bodies AS (
  SELECT rid, regexp_replace(coalesce(string_agg(rest, chr(10) ORDER BY i) FILTER (level = 0), ''),
                             '^\s+|\s+$', '', 'g') AS body FROM lines GROUP BY rid)
SELECT conv_id, turn, role, quotes, linked, reply_to, thread,
       row_number() OVER (PARTITION BY conv_id ORDER BY thread, turn, rid) AS position,
       '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || body || chr(10) AS formatted
FROM replies JOIN roots USING (conv_id, turn) JOIN bodies USING (rid)
"""


def _quality_sql() -> str:
    """Counts by patterns, the rules as they are, and expectation-maximisation as a recursion over its steps."""
    n, rules = len(quality.RULES), quality.RULES
    votes = ", ".join(f"CASE WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END" for r in rules)
    yes = lambda a: f"list_transform(range(1, {n + 1}), lambda j: CASE x.v[j] WHEN 1 THEN {a[0]} WHEN -1 THEN {a[1]} ELSE 1.0::DOUBLE END)"
    if_good = f"share * list_product({yes(('good[j]', '1 - good[j]'))})"
    if_bad = f"(1 - share) * list_product({yes(('1 - bad[j]', 'bad[j]'))})"
    belief = f"list_transform(p, lambda x: {if_good} / ({if_good} + {if_bad}))"
    weighted = lambda of, sign: f"list_sum(list_transform(range(1, len(p) + 1), lambda i: CASE WHEN p[i].v[j] {sign} THEN p[i].t * ({of}) ELSE 0 END))"
    right = lambda of, sign, start: (
        f"list_transform(range(1, {n + 1}), lambda j: ({weighted(of, sign)} + {quality.WEIGHT * start}::DOUBLE)"
        f" / ({weighted(of, '<> 0')} + {quality.WEIGHT}::DOUBLE))")
    started = lambda v: "[" + ", ".join([f"{v}::DOUBLE"] * n) + "]"
    return rf"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS row_, doc_id, coalesce(text, '') AS t FROM documents),
cut AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, regexp_replace(t, '[\x20\x09-\x0D]', '', 'g') AS solid,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM texts),
windows AS (
  SELECT row_, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT row_, words, unnest(range(1, len(words) - 1)) AS i FROM cut)),
twice AS (
  SELECT row_, i FROM (SELECT row_, i, count(*) OVER (PARTITION BY row_, w) AS c FROM windows) WHERE c > 1),
covered AS (
  SELECT row_, count(DISTINCT i + s) AS n_repeat_words FROM twice, (SELECT unnest([0, 1, 2]) AS s) GROUP BY row_),
counts AS (
  SELECT row_, doc_id, len(words)::BIGINT AS n_words, len(solid)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(regexp_extract_all(t, '[A-Z]')) AS n_upper, len(regexp_extract_all(t, '[a-z]')) AS n_lower,
         len(regexp_extract_all(t, '[!-/:-@\[-`{{-~]')) AS n_marks, len(list_distinct(words)) AS n_distinct,
         len(list_filter(words, lambda w: regexp_full_match(w, '[!-/:-@\[-`{{-~]+'))) AS n_bare
  FROM cut LEFT JOIN covered USING (row_)),
voted AS (SELECT *, [{votes}] AS v FROM counts),
seen AS (SELECT list({{'v': v, 't': t}} ORDER BY v) AS p, sum(t)::DOUBLE AS total FROM (SELECT v, count(*) AS t FROM voted GROUP BY v)),
steps AS (
  SELECT 0 AS step, {quality.START_SHARE}::DOUBLE AS share, {started(quality.START_GOOD)} AS good, {started(quality.START_BAD)} AS bad
  UNION ALL
  SELECT step + 1,
         (list_sum(list_transform(range(1, len(p) + 1), lambda i: p[i].t * b[i])) + {quality.WEIGHT * quality.START_SHARE}::DOUBLE)
           / (total + {quality.WEIGHT}::DOUBLE),
         {right('b[i]', '> 0', quality.START_GOOD)}, {right('1 - b[i]', '< 0', quality.START_BAD)}
  FROM (SELECT step, p, total, {belief} AS b FROM steps, seen WHERE step < {quality.STEPS})),
believed AS (
  SELECT unnest(p).v AS v, unnest({belief}) AS belief FROM steps, seen WHERE step = {quality.STEPS})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND belief >= {quality.LEAST} AS kept
FROM voted JOIN believed USING (v)"""


QUALITY_SQL = _quality_sql()

TRIE_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
           ORDER BY turn NULLS FIRST, sha256(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS at_
  FROM conversations WHERE conv_id IS NOT NULL),
lists AS (
  SELECT conv_id, list({'k': len(role) || ':' || role || text, 'w': strlen(text)} ORDER BY at_) AS own
  FROM turns GROUP BY conv_id),
shares AS (
  SELECT conv_id, conv_id - conv_id % 5 AS giver, own,
         xor(4294967295::BIGINT, list_reduce(
           list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
           lambda c, b: list_reduce(range(8), lambda z, i: CASE WHEN z & 1 = 1 THEN xor(z >> 1, 3988292384::BIGINT) ELSE z >> 1 END, xor(c, b)),
           4294967295::BIGINT)) % 9 AS h
  FROM lists),
rebuilt AS (
  SELECT s.conv_id, coalesce(g.own[1:s.h], []) || s.own[s.h + 1:] AS seq
  FROM shares s LEFT JOIN lists g ON g.conv_id = s.giver),
rows_ AS (
  SELECT conv_id, d, md5(array_to_string(list_transform(seq[1:d], lambda x: md5(x.k)), ',')) AS key, seq[d].w AS w, len(seq) AS n,
         CASE WHEN d > 0 THEN md5(array_to_string(list_transform(seq[1:d - 1], lambda x: md5(x.k)), ',')) END AS up
  FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT d, key, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(coalesce(w, 0)) AS w,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM rows_ GROUP BY d, key),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.d = n.d + 1 AND c.up = n.key) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.d = n.d - 1 AND p.key = n.up),
totals AS (
  SELECT r.d, r.key, count(*) FILTER (n.n_children = 0) AS n_leaves, sum((n.n_convs - 1) * n.w) AS saved_tokens
  FROM linked n JOIN rows_ r ON r.conv_id = n.conv_id AND r.d <= n.d GROUP BY r.d, r.key)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM linked JOIN totals USING (d, key)
"""


@_catalog.query(MIX_SQL)
def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the words that a 5:2:1 mix of their sources takes."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "copies", "taken")


@_catalog.query()
def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens at most."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@_catalog.query()
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files, and what a reader finds in them."""
    path = scratch_dir(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return token_files.with_checksum(token_files.read_tokens(spark, path))


@_catalog.query(SECRETS_SQL)
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, each distinct text scanned once."""
    scanned = secrets.scan_versions(table(spark, sf_dir, "documents"), scratch_dir(spark, "ledger"))
    of = lambda kind: F.filter("found", lambda s: s["kind"] == kind)
    base = F.filter("found", lambda s: s["rank"] < len(secrets.BASE_RULES))
    return scanned.select(
        "doc_id",
        *[F.size(of(rule.kind)).cast("bigint").alias(f"n_{rule.kind}") for rule in secrets.BASE_RULES],
        F.sha2(secrets.span_list(base).cast("binary"), 256).alias("base_sha256"),
        secrets.span_list(F.col("found")).alias("spans"))


@_catalog.query()
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of all documents."""
    found = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.col("places")["start"]
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min(starts).cast("bigint").alias("first_word"), F.array_max(starts).cast("bigint").alias("last_word"),
        "base_labels", "labels", "score")


@_catalog.query()
def op9_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents; a quarter of them is never learned from."""
    docs = table(spark, sf_dir, "documents")
    held = languages.held_out(F.col("doc_id"))
    model = languages.train(docs, ~held)
    return languages.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score")


@_catalog.query()
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: shingles of three words, three bits at most."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)


@_catalog.query()
def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links of all embeddings at a cosine of 0.93."""
    return embeddings.near_embeddings(table(spark, sf_dir, "embeddings"), 0.93)


@_catalog.query(TOP_K_SQL)
def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best inner products for every hundredth embedding, over all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@_catalog.query(QUOTES_SQL)
def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in reply order, without what messages quote."""
    chat = quoting.link_quotes(table(spark, sf_dir, "conversations"))
    return chat.select("conv_id", "turn", "role", "quotes", "linked", "reply_to", "thread", "position", "formatted")


@_catalog.query(QUALITY_SQL)
def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with what rules vote on and whether their weighed votes keep them."""
    judged = quality.judge(table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (~failed & (F.col("quality") >= quality.LEAST)).alias("kept"))


@_catalog.query(TRIE_SQL)
def op12_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    nodes = trie.trie_nodes(*rebuilding.rebuilt(table(spark, sf_dir, "conversations")))
    return nodes.select(F.col("seq_id").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"),
                        F.col("n_seqs").alias("n_convs"), "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
                        "ends_sha256")


@_catalog.query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened along their eight leading components."""
    white = whitening.whiten(table(spark, sf_dir, "embeddings"), 8)
    entry = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "entry")
    return white.select("vec_id", "n", "deviation", "identity_error", entry).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("entry.whitened").alias("whitened"),
        F.col("entry.explained").alias("explained"), "identity_error")
