"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html_extract, language_id, lm_scoring, toxicity
from .byte_dedup import dedup_bytes
from .chat import format_chats, loss_text, parsed_turns
from .common import crc32_of_id, read
from .decontaminate import contamination, is_contaminated
from .mixing import mix
from .ngram_jaccard import near_duplicate_components
from .periodic_runs import periodic_runs
from .spelling import count_words, group_variants, misspelt
from .substring_dedup import dedup_substrings
from .topk import self_search


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = read(spark, sf_dir, "documents"), toxicity.held_out()
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), learn_from=~out)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = read(spark, sf_dir, "documents"), language_id.held_out()
    labelled = language_id.identify(docs, language_id.fit(docs, learn_from=~out))
    return labelled.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                       F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), is_contaminated().alias("contaminated"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_substrings(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_components(read(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read(spark, sf_dir, "documents"))
    return mixed.select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return lm_scoring.fit_and_score(docs, read(spark, sf_dir, "labels"), wanted=F.col("quality") == 1)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql("SELECT stack(2, -1L, 0L, 'user', '</s>[INST] ok [/INST]', -1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS (conv_id, turn, role, text)")
    chats = format_chats(turns.unionByName(probe)).withColumn("turns", parsed_turns(F.col("formatted"))).withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return self_search(read(spark, sf_dir, "embeddings"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_bytes(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the words of documents, a code point of every 199th pair of document and word deleted."""
    return group_variants(count_words(read(spark, sf_dir, "documents"), change=lambda word: misspelt("doc_id", word)))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """docs, of which every tenth (by the crc32 of its id) repeats a part of itself to its end; words stay apart."""
    h = crc32_of_id("doc_id")
    g, n = F.floor(h / 10).cast("long"), F.size("w").cast("long")
    words = docs.withColumn("w", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    words = words.withColumn("a", F.when(n > 0, g % n)).withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("long"))
    tail = F.transform("w", lambda word, i: F.when(i < F.col("a"), word).otherwise(F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return words.withColumn("text", F.when(F.size("w") > 0, F.array_join(tail, " ")).otherwise(F.col("text"))).drop("w", "a", "p")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periodic_tails(read(spark, sf_dir, "documents")))
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    found = found.withColumn("best", best).withColumn("length", -F.col("best.less"))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "length", "best.period", F.floor(1000 * F.col("length") / F.col("best.period")).cast("long").alias("exponent_milli"),
                        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_decontaminate": op2_decontaminate,
    "op3_language_id": op3_language_id,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_html_extract": op5_html_extract,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_mixing": op7_mixing,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_chat_format": op9_chat_format,
    "op10_topk_search": op10_topk_search,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_periodic_runs": op13_periodic_runs,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM_WORDS = "regexp_extract_all(" + _LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_PLAIN_WORDS = r"coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), [])"

#: crc32 for DuckDB: the table of a byte's remainders, and the fold over a list of bytes.
_CRC_TABLE = """crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
  lambda c, z: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)))"""
_CRC = "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {}), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)"
_ID_BYTES = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))"

ORACLE_SQL = {
    "op2_decontaminate": f"""
WITH d AS (SELECT doc_id, coalesce({_ALNUM_WORDS}, []) AS w FROM documents),
i AS (SELECT item_id, coalesce({_ALNUM_WORDS}, []) AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, list_slice(w, s, s + least(13, len(w)) - 1) AS g
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n),
h AS (SELECT dw.doc_id, dw.s, dw.n, iw.item_id FROM dw JOIN iw ON iw.n = dw.n AND list_slice(dw.w, dw.s, dw.s + dw.n - 1) = iw.g),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)""",
    "op4_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
g AS (SELECT doc_id, s, md5(array_to_string(list_slice(w, s, s + 19), ' ')) AS h
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)),
r AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS n FROM g) WHERE n > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(s, s + 20)) AS p FROM r) GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT words.doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
         FROM words LEFT JOIN gone USING (doc_id) WHERE gone.ps IS NULL OR NOT list_contains(gone.ps, p) GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op6_ngram_jaccard": f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
g AS (SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, s, s + least(3, len(w)) - 1), ' ')) AS h
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 190 * c >= 90 * (x.n + y.n)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS node, a AS other FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.other),
c AS (SELECT node, min(other) AS component FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = d.doc_id""",
    "op7_mixing": r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST(([3, 1, 2])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS BIGINT) AS weight,
      2 * source_size AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM s),
f AS (SELECT *, 3 * total - 2 * CAST(coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest,
      2 * CAST(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS open FROM w),
l AS (SELECT max(rest / open) AS level FROM f WHERE cap * open >= weight * rest),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), level * weight) AS target FROM f, l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
      CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0 AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r""",
    "op9_chat_format": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
o AS (SELECT *, row_number() OVER w AS n, lag(role) OVER w AS before FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
e AS (SELECT *, length(text) + length(regexp_replace(text, '[^<\[\\]', '', 'g')) AS text_chars,
      length(role) + length(regexp_replace(role, '[^<\[\\]', '', 'g')) AS role_chars FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(text_chars + CASE WHEN role = before THEN 8 ELSE 28 + role_chars END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""",
    "op10_topk_search": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20""",
    "op11_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
part AS (SELECT doc_id, c, substr(x, 1024 * c + 1, 1122) AS x FROM (SELECT doc_id, x, unnest(range(0, CAST(ceil(length(x) / 1024) AS BIGINT))) AS c FROM d)),
g AS (SELECT doc_id, 512 * c + s AS s, md5(substr(x, 2 * s + 1, 100)) AS h
      FROM (SELECT doc_id, c, x, unnest(range(0, least(512, CAST(length(x) / 2 - 49 AS BIGINT)))) AS s FROM part WHERE length(x) >= 100)),
f AS (SELECT h, min(doc_id) AS first_doc FROM g GROUP BY h HAVING min(doc_id) <> max(doc_id)),
r AS (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM g JOIN f USING (h) WHERE doc_id > first_doc),
i AS (SELECT doc_id, s, sum(CASE WHEN before IS NULL OR s > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM r),
gone AS (SELECT doc_id, min(s) AS a, max(s) + 50 AS b FROM i GROUP BY doc_id, run),
cut AS (SELECT doc_id, a, b, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS next_a, row_number() OVER (PARTITION BY doc_id ORDER BY a) AS k FROM gone),
kept AS (SELECT d.doc_id, string_agg(CASE WHEN k = 1 THEN substr(x, 1, 2 * a) ELSE '' END || substr(x, 2 * b + 1, coalesce(2 * next_a, length(x)) - 2 * b), '' ORDER BY a) AS y,
  sum(b - a) AS n_removed, count(*) AS n_spans FROM cut JOIN d USING (doc_id) GROUP BY d.doc_id)
SELECT d.doc_id, CAST(length(x) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(y, x))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op12_spelling_variants": f"""
WITH RECURSIVE {_CRC_TABLE},
run AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[a-zÀ-ÿ]+')) AS w FROM documents),
dw AS (SELECT doc_id, w, count(*) AS c FROM run WHERE length(w) >= 6 GROUP BY doc_id, w),
dh AS (SELECT w, c, {_CRC.format("flatten([" + _ID_BYTES + ", [58], flatten(list_transform(string_split(w, ''), lambda x: CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)] ELSE [195, CAST(ord(x) AS BIGINT) - 64] END))])")} AS h FROM dw, crc),
v AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, c FROM dh),
vocab AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM v WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
del AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS d FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM vocab)),
near AS (SELECT a.word, b.word AS other, b.n FROM del a JOIN vocab b ON a.d = b.word UNION SELECT b.word, a.word, a.n FROM del a JOIN vocab b ON a.d = b.word
  UNION SELECT a.word, b.word, b.n FROM del a JOIN del b ON a.i = b.i AND a.d = b.d AND a.word <> b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, struct_pack(a := -n, b := other)) AS other, max(n) AS other_n FROM near GROUP BY word),
judged AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * v.n THEN other END AS form, CASE WHEN other_n >= 5 * v.n THEN other_n END AS form_n FROM vocab v LEFT JOIN best b ON b.word = v.word),
chain AS (SELECT word, word AS at FROM judged UNION ALL SELECT c.word, j.form FROM chain c JOIN judged j ON j.word = c.at WHERE j.form IS NOT NULL),
root AS (SELECT c.word, c.at AS root FROM chain c JOIN judged j ON j.word = c.at WHERE j.form IS NULL)
SELECT j.word, j.form, r.root, j.n, j.n_near, j.form_n FROM judged j JOIN root r ON r.word = j.word""",
    "op13_periodic_runs": f"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, {_CRC.format(_ID_BYTES)} AS h, {_PLAIN_WORDS} AS w FROM documents, crc),
p AS (SELECT doc_id, w, h, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
t AS (SELECT doc_id, CASE WHEN a IS NULL THEN w ELSE list_transform(w, lambda x, i: CASE WHEN i - 1 < a THEN x ELSE w[a + (i - 1 - a) % (1 + (len(w) - a) // (3 + (h // 10) % 8)) + 1] END) END AS w FROM p),
g AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i + 1, i + 6), ' ')) AS x FROM (SELECT doc_id, w, unnest(range(0, len(w) - 5)) AS i FROM t WHERE len(w) >= 12)),
m AS (SELECT a.doc_id, a.i - b.i AS q, a.i FROM g a JOIN g b ON a.doc_id = b.doc_id AND a.x = b.x AND a.i > b.i),
s AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS diagonal FROM m),
l AS (SELECT doc_id, q, min(i) - q AS start, count(*) + 5 + q AS length FROM s GROUP BY doc_id, q, diagonal HAVING count(*) + 5 >= greatest(12 - q, q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM l GROUP BY doc_id, start, length),
n AS (SELECT doc_id, count(*) AS n_runs, arg_min(struct_pack(s := start, l := length, p := period), struct_pack(a := -length, b := start, c := period)) AS best,
  string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM t),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM (SELECT words.* FROM words ANTI JOIN gone USING (doc_id, i)) GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period, CAST(1000 * best.l // best.p AS BIGINT) AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)""",
}
