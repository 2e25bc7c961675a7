"""The registered query of each operator, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guichet.llm import alignment, conversation_trie, cover_tree, embedding_dedup, language, licences, minhash, mixing, packing, pii, repeats, sharding, warc
from guichet.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def public_vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@registered()
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = language.fit(docs.filter(~F.col("held_out")), public_vocabulary("piece_bpe_32k.model"))
    return language.identify(docs, model).select("doc_id", "held_out", "lang_pred", "score")


@registered()
def op7_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_vocabulary("word_bpe_49k.json"), remembered=600_000)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@registered()
def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.balance(table(spark, sf_dir, "documents"), 24)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


_MIX_SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+'))::BIGINT AS size,
    (('0x' || substr(md5('0|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 13))::BIGINT + 0.5::DOUBLE)
      / 4503599627370496::DOUBLE AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::DOUBLE AS w,
    row_number() OVER (ORDER BY source NULLS LAST) AS i, 3.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER p, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER p, 0)) AS level
    FROM w WINDOW p AS (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN cap <= w * level THEN cap
    ELSE w * max(CASE WHEN cap > w * level THEN level END) OVER () END AS target FROM l),
e AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE) ELSE 0 END AS times
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
f AS (SELECT *, floor(times)::BIGINT AS whole, times - floor(times) AS p FROM e),
q AS (SELECT *, CASE WHEN p > 0 THEN u / (1 - u) * ((1 - p) / p) END AS odds,
    target - sum(whole * size) OVER (PARTITION BY source) AS rest FROM f),
c AS (SELECT *, sum(size) OVER (PARTITION BY source, odds) AS tied,
    sum(size) OVER (PARTITION BY source ORDER BY odds RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= rest AS fits,
    rest - coalesce(max(reach) FILTER (reach <= rest) OVER (PARTITION BY source), 0) AS gap
    FROM (SELECT *, CASE WHEN p > 0 THEN sum(size) OVER (PARTITION BY source ORDER BY odds RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END
      AS reach FROM q)),
b AS (SELECT source, min({'miss': abs(tied - gap), 'rank': odds}) AS best FROM c
    WHERE p > 0 AND NOT fits AND abs(tied - gap) < gap GROUP BY source)
SELECT doc_id, size, source_size, round(target, 3) AS target,
  ((whole + CASE WHEN p > 0 AND (fits OR odds = best.rank) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM c LEFT JOIN b ON c.source IS NOT DISTINCT FROM b.source
"""


@registered(_MIX_SQL)
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), "taken")


_NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \t-\r]+'), lambda x: x <> '') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []::VARCHAR[] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * common >= 85 * (x.n + y.n - common)),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.seen),
c AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id)
SELECT c.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n ON n.doc_id = c.doc_id
"""


@registered(_NEAR_SQL)
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


_TOP_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.v, d.v)::BIGINT AS score FROM v q JOIN v d ON q.vec_id <> d.vec_id
  WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@registered(_TOP_SQL)
def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


_LINKED_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
r(vec_id, seen) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON l.a = r.seen),
c AS (SELECT vec_id, min(seen) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT c.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, c.vec_id = component_id AS kept FROM c LEFT JOIN n ON n.vec_id = c.vec_id
"""


@registered(_LINKED_SQL)
def op5_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def _repeats_sql(window: int = 400) -> str:
    """Every window of every text, named by digests that double in length; what names occur twice cover goes."""
    steps, name, width = [], "bytes", 1
    while width < window:
        shift = min(width, window - width)
        grown = f"w{width + shift}"
        steps.append(f"{grown} AS (SELECT doc, pos, byte, md5(word || lead(word, {shift}) OVER (PARTITION BY doc ORDER BY pos)) AS word FROM {name})")
        name, width = grown, width + shift
    return f"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, hex(encode(coalesce(text, ''))) AS hex FROM documents),
lists AS (SELECT doc, regexp_extract_all(hex, '..') AS list FROM d),
bytes AS (SELECT doc, unnest(range(len(list))) AS pos, unnest(list) AS byte, byte AS word FROM lists),
{("," + chr(10)).join(steps)},
counted AS (SELECT doc, pos, byte, word IS NOT NULL AND count(*) OVER (PARTITION BY word) > 1 AS repeated FROM {name}),
covered AS (SELECT doc, pos, byte, max(repeated) OVER (PARTITION BY doc ORDER BY pos ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW) AS removed FROM counted),
edges AS (SELECT doc, pos, byte, removed, removed AND NOT coalesce(lag(removed) OVER (PARTITION BY doc ORDER BY pos), false) AS opens FROM covered),
cut AS (SELECT doc, count(*) FILTER (removed) AS n_removed, count(*) FILTER (opens) AS n_spans,
    string_agg(byte, '' ORDER BY pos) FILTER (NOT removed) AS kept FROM edges GROUP BY doc)
SELECT doc_id, (len(hex) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc)
"""


@registered(_repeats_sql())
def op9_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def _licence_sql() -> str:
    rows = []
    for i, (name, text) in enumerate(licences.TEMPLATES):
        _, least, most = licences.bounds(text, 0.8)
        rows.append("({}, '{}', {}, {}, '{}')".format(i, name, least, most, " ".join(licences.normalised_words(text))))
    bigrams = "list_distinct(list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]))"
    return rf"""
WITH t(template, licence, least, most, words) AS (VALUES
  {(","+chr(10)+"  ").join(rows)}),
tg AS (SELECT template, licence, least, most, {bigrams.format("string_split(words, ' ')")} AS g FROM t),
n AS (SELECT row_number() OVER () AS r, doc_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(
    translate(text, '{licences.UPPER}', '{licences.LOWER}'), '[.!?;:]+[ \t\r]', chr(10), 'g'), '[^a-z0-9\n]+', ' ', 'g'), chr(10)),
    lambda u: list_filter(string_split(u, ' '), lambda x: x <> '')), lambda u: len(u) > 0) AS units FROM documents),
d AS (SELECT r, flatten(units) AS w FROM n),
p AS (SELECT r, template, licence, least, most, tg.g FROM (SELECT r, {bigrams.format("w")} AS g FROM d WHERE len(w) > 1) x, tg
  WHERE len(list_intersect(x.g, tg.g)) >= least),
u AS (SELECT r, unnest(range(1, len(units) + 1)) AS pos, unnest(list_transform(units, lambda x: len(x))) AS size FROM n WHERE r IN (SELECT r FROM p)),
e AS (SELECT r, pos, sum(size) OVER (PARTITION BY r ORDER BY pos)::BIGINT AS last, size FROM u),
s AS (SELECT p.r, template, licence, p.g, d.w[a.last - a.size + 1:b.last] AS w FROM p JOIN e a ON a.r = p.r JOIN e b ON b.r = p.r AND b.pos >= a.pos
    AND b.last - (a.last - a.size) - 1 BETWEEN p.least AND p.most JOIN d ON d.r = p.r),
m AS (SELECT r, template, licence, max(2.0::DOUBLE * len(list_intersect(x, g)) / (len(x) + len(g))) AS dice
  FROM (SELECT *, {bigrams.format("w")} AS x FROM s) GROUP BY ALL),
b AS (SELECT r, min({{'d': -dice, 't': template, 'l': licence}}) AS best, count(*) AS n FROM m WHERE dice >= 0.8 GROUP BY r)
SELECT doc_id, best.l AS licence, round(-best.d, 6) AS licence_dice, coalesce(b.n, 0)::BIGINT AS licence_matches FROM n LEFT JOIN b ON n.r = b.r
"""


@registered(_licence_sql())
def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "licence", F.round("licence_dice", 6).alias("licence_dice"), "licence_matches")


#: In production a secret of the deployment; here a fixed one, so that reruns agree.
SURROGATE_KEY = b"corpus-surrogates"


@registered()
def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, SURROGATE_KEY).withColumn("n_entities", F.size("pii_spans").cast("long"))


@registered()
def op11_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_vocabulary("byte_bpe_50k.json"), public_vocabulary("piece_bpe_32k.model"))


_WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
    max(page_id) OVER (PARTITION BY html) AS latest FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < latest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < latest THEN latest END AS refers_to
FROM d
"""


@registered(_WARC_SQL)
def op12_web_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), path, key="page_id", url="url", payload="html")
    pages = warc.read_pages(spark, path)
    return pages.select(F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


_TRIE_SQL = """
WITH t AS (SELECT conv_id, len(coalesce(text, ''))::BIGINT AS points, md5(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, turn
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({'d': digest, 'p': points} ORDER BY turn NULLS FIRST, digest) AS own,
    xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END))) % 6 AS h
  FROM t GROUP BY conv_id),
r AS (SELECT c.conv_id, list_concat(coalesce(b.own, [])[1:c.h], c.own[c.h + 1:]) AS turns FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 100),
p AS (SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM r),
k AS (SELECT conv_id, n, depth, md5(array_to_string(list_transform(turns[1:depth], lambda x: x.d), '')) AS key,
    CASE WHEN depth > 0 THEN md5(array_to_string(list_transform(turns[1:depth - 1], lambda x: x.d), '')) END AS up,
    CASE WHEN depth > 0 THEN turns[depth].p ELSE 0 END AS points FROM p),
m AS (SELECT depth, key, any_value(up) AS up, any_value(points) AS points, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth)), sha256('')) AS ends_sha256 FROM k GROUP BY depth, key),
f AS (SELECT a.*, b.conv_id AS parent_conv_id, (SELECT count(*) FROM m x WHERE x.up = a.key AND x.depth = a.depth + 1) AS n_children
  FROM m a LEFT JOIN m b ON b.key = a.up AND b.depth = a.depth - 1),
-- Each node lies below the prefixes of its smallest member.
s AS (SELECT k.depth, k.key, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.points) AS saved_tokens
  FROM f JOIN k ON k.conv_id = f.conv_id AND k.depth <= f.depth GROUP BY k.depth, k.key)
SELECT f.conv_id, f.depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM f JOIN s ON s.key = f.key AND s.depth = f.depth
"""


@registered(_TRIE_SQL)
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = conversation_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    first = own.filter("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 5).alias("head"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    joined = own.join(first, F.col("conv_id") - F.col("conv_id") % 100 == F.col("base"), "left").withColumn("h", h.cast("int"))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    rebuilt = joined.select("conv_id", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))
    return conversation_trie.prefix_trie(rebuilt)
