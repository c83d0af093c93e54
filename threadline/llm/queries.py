"""Registered queries of the operators, one for each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadline.llm import bottomk, fingerprint, jaccard, language, mixture, pieces, quality, runs, sharding, substring, token_files, topk, trie
from threadline.llm.inputs import table
from threadline.plans.scratch import Scratch

Query = Callable[[SparkSession, str], DataFrame]


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Scratch(spark, 'tokens').root}/ids"
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"))
    return token_files.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("passes") * F.col("size")).cast("long").alias("taken"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), 20, F.col("vec_id") % 20 == 0)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = pieces.encode_and_decode(docs, tokenizer_file("piece_bpe_32k.model"))
    return done.select(
        "doc_id", F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"), "pieces", F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("same"),
    )


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(held_out(), F.lit(False))
    model = language.train(docs.where(~held))
    return language.predict(docs.select("doc_id", "text", held.alias("held_out")), model).drop("text")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out())


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk.near_duplicates(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # The rows that are to repeat from some word on are built first.
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    docs = docs.withColumn("g", g).withColumn("words", words).withColumn("n", F.size("words").cast("long"))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    docs = docs.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    at = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    built = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.element_at("words", (at(i) + 1).cast("int")))
    docs = docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(built, " ")).otherwise(F.col("text")).alias("text"))
    found = runs.find_runs(docs)
    better = lambda x, y: (
        F.when(x["length"] * y["period"] > y["length"] * x["period"], -1).when(x["length"] * y["period"] < y["length"] * x["period"], 1)
        .when(x["start"] != y["start"], F.signum(x["start"] - y["start"]).cast("int")).otherwise(F.signum(x["period"] - y["period"]).cast("int"))
    )
    best = F.try_element_at(F.array_sort("runs", better), F.lit(1))
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    lines = F.array_join(F.transform("runs", line), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "trie")
    said = scratch.save(trie.sequences(table(spark, sf_dir, "conversations")), "said")
    # Each conversation begins with turns of the first of its group of five.
    heads = said.where("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    own = F.slice("turns", h + 1, F.size("turns"))
    turns = F.when(F.col("head").isNull(), own).otherwise(F.concat(F.slice("head", F.lit(1), h), own))
    rebuilt = said.withColumn("base", F.expr("conv_id - conv_id % 5")).join(heads, "base", "left").select("conv_id", turns.alias("turns"))
    return trie.prefix_trie(rebuilt, scratch)


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_token_files": op2_token_files,
    "op3_mixture": op3_mixture,
    "op4_sharding": op4_sharding,
    "op5_exact_topk": op5_exact_topk,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_fingerprints": op7_fingerprints,
    "op8_language_id": op8_language_id,
    "op9_quality": op9_quality,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_minhash_near_dedup": op11_minhash_near_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_prefix_trie": op13_prefix_trie,
}
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# CRC-32 of a text of ASCII characters, from its definition.
_CRC_TABLE = (
    "list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], "
    "lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
)
_CRC_IDS = """SELECT id, xor(list_reduce(list_concat([4294967295::BIGINT], [ascii(c)::BIGINT FOR c IN string_split(id::VARCHAR, '')]),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS h FROM ids, crc"""

_COMPONENTS = """
WITH RECURSIVE docs AS (
    SELECT doc_id, [translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FOR x IN {words}] AS w FROM documents),
  shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
  sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
  common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
  links AS MATERIALIZED (
    SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * shared >= {like} * (p.n + q.n - shared)),
  reach AS (
    SELECT x AS doc_id, y FROM links UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.y),
  least AS (SELECT doc_id, min(y) AS y FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id{more}
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": _COMPONENTS.format(words=_WORDS, like=75, more=""),
    "op5_exact_topk": """
WITH v AS (
    SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum([x[1] * x[2] FOR x IN list_zip(q.e, c.e)])::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s) WHERE rank <= 20
""",
    "op10_substring_dedup": f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
  starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs WHERE len(w) >= 13),
  windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS words FROM starts),
  least AS (SELECT words, min(doc_id) AS first_doc FROM windows GROUP BY words),
  gone AS (SELECT DISTINCT doc_id, i + unnest(range(0, 13)) AS i FROM windows JOIN least USING (words) WHERE doc_id > first_doc),
  lists AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string([w[j] FOR j IN range(1, len(w) + 1) IF NOT list_contains(coalesce(gone, []), j)], ' ')) AS kept_sha256
FROM docs LEFT JOIN lists USING (doc_id)
""",
    "op11_minhash_near_dedup": _COMPONENTS.format(words=_WORDS, like=85, more=", component_id = doc_id AS kept"),
    "op12_periodic_runs": f"""
WITH crc AS MATERIALIZED (SELECT {_CRC_TABLE} AS t), ids AS (SELECT DISTINCT doc_id AS id FROM documents),
  hashed AS MATERIALIZED ({_CRC_IDS}),
  given AS (SELECT doc_id, h, h // 10 AS g, {_WORDS} AS w, len({_WORDS}) AS n FROM documents JOIN hashed ON id = doc_id),
  cut AS (SELECT *, CASE WHEN n > 0 THEN g % n ELSE 0 END AS a FROM given),
  docs AS MATERIALIZED (
    SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
      THEN [w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END] FOR i IN range(n)] ELSE w END AS w FROM cut),
  fives AS MATERIALIZED (
    SELECT doc_id, n, i, array_to_string(w[i + 1:i + 5], ' ') AS five FROM (SELECT doc_id, n, w, unnest(range(n - 4)) AS i FROM docs WHERE n >= 6)),
  pairs AS (
    SELECT y.doc_id, y.i, y.i - x.i AS q, y.i - row_number() OVER (PARTITION BY y.doc_id, y.i - x.i ORDER BY y.i) AS island
    FROM fives x JOIN fives y ON x.doc_id = y.doc_id AND x.five = y.five AND x.i < y.i AND 4 * (y.i - x.i) <= y.n),
  stretches AS (SELECT doc_id, q, min(i) - q AS start, max(i) + 5 AS stop FROM pairs GROUP BY doc_id, q, island),
  found AS MATERIALIZED (
    SELECT doc_id, start, stop - start AS length, min(q) AS period FROM stretches WHERE stop - start >= greatest(6, 4 * q) GROUP BY doc_id, start, stop),
  best AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY (length // period) DESC, (length % period)::DOUBLE / period DESC, start, period) AS rn FROM found)
    WHERE rn = 1),
  lists AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM found GROUP BY doc_id),
  gone AS (SELECT doc_id, list(DISTINCT i) AS gone FROM (SELECT doc_id, unnest(range(start + period, start + length)) AS i FROM found) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
  (length * 1000 // period)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE array_to_string([w[j + 1] FOR j IN range(n) IF NOT list_contains(gone, j)], ' ') END) AS collapsed_sha256
FROM docs d LEFT JOIN best USING (doc_id) LEFT JOIN lists USING (doc_id) LEFT JOIN gone USING (doc_id)
""",
    "op13_prefix_trie": f"""
WITH crc AS MATERIALIZED (SELECT {_CRC_TABLE} AS t), ids AS (SELECT DISTINCT conv_id AS id FROM conversations WHERE conv_id IS NOT NULL),
  hashed AS MATERIALIZED ({_CRC_IDS}),
  said AS MATERIALIZED (
    SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS s
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
  built AS MATERIALIZED (
    SELECT c.conv_id, list_concat(coalesce(b.s, [])[1:h % 9], c.s[h % 9 + 1:]) AS s
    FROM said c JOIN hashed ON id = c.conv_id LEFT JOIN said b ON b.conv_id = c.conv_id - c.conv_id % 5),
  prefixes AS (SELECT conv_id, len(s) AS own, s, unnest(range(len(s) + 1)) AS depth FROM built),
  nodes AS MATERIALIZED (
    SELECT s[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
      coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (own = depth), '') AS ends FROM prefixes GROUP BY ALL),
  kids AS (SELECT prefix[1:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
  full_nodes AS MATERIALIZED (
    SELECT n.*, coalesce(k.n_children, 0) AS n_children, CASE WHEN n.depth > 0 THEN strlen(n.prefix[n.depth].t) ELSE 0 END AS bytes
    FROM nodes n LEFT JOIN kids k ON k.prefix = n.prefix AND k.depth = n.depth),
  below AS (
    SELECT prefix[1:d] AS prefix, d AS depth, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
    FROM (SELECT *, unnest(range(depth + 1)) AS d FROM full_nodes) GROUP BY ALL)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children,
  b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_nodes n JOIN below b ON b.prefix = n.prefix AND b.depth = n.depth
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
""",
}
