"""Registered queries of this package: name -> (query, reference SQL or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.llm import alignment, byte_bpe, collocations, conversations, embedding_forest, minhash, packing, pruned_graph, quality, recurrent_lm, repeats, sharding, url_filter
from trolley.llm.common import table


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.quality_rules(table(spark, sf_dir, "documents"))
    return rows.withColumns({c: F.round(c, 6) for c in ("class_distance", "word_distance")})


#: Histograms, references and distances as the operator's docstring defines them, limits as in ``quality.Rules``.
OP10_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos
    FROM (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d)
), tri AS (
    SELECT rid, pos, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY rid ORDER BY pos)
), twice AS (
    SELECT rid, pos FROM tri WHERE w3 IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, w, w2, w3) > 1
), repeats AS (
    SELECT rid, count(DISTINCT pos + k) AS n_repeat_words FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid
), lines AS (
    SELECT rid, sum(n - 1)::BIGINT AS n_dup_lines FROM (
        SELECT rid, line, count(*) AS n FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid, line) GROUP BY rid
), sizes AS (
    SELECT rid, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars FROM w GROUP BY rid
), base AS (
    SELECT d.*, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
           coalesce(n_words, 0) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * coalesce(n_words, 0) AS base_failed
    FROM d LEFT JOIN sizes USING (rid) LEFT JOIN repeats USING (rid) LEFT JOIN lines USING (rid)
), classes AS (
    SELECT rid, unnest([0, 1, 2, 3, 4, 5, 6]) AS item, unnest([lo, up, ot, di, sp, pu, n - lo - up - ot - di - sp - pu]) / n::DOUBLE AS share FROM (
        SELECT rid, length(t) AS n, length(regexp_replace(t, '[^a-z]', '', 'g')) AS lo, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS up,
               length(regexp_replace(t, '[\x00-\x7F]', '', 'g')) AS ot, length(regexp_replace(t, '[^0-9]', '', 'g')) AS di,
               length(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')) AS sp,
               length(regexp_replace(t, '[^.,;:!?''"()\-]', '', 'g')) AS pu
        FROM base WHERE n_words >= 50)
), counts AS (
    SELECT rid, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS item, count(*) AS n FROM w GROUP BY ALL
), firsts AS (
    SELECT rid, lang, n_words FROM base WHERE lang IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY lang, t ORDER BY rid) = 1 AND NOT base_failed
), langs AS (
    SELECT lang, count(*) AS texts FROM firsts GROUP BY lang HAVING count(*) >= 20
), class_mean AS (
    SELECT lang, item, share / sum(share) OVER (PARTITION BY lang) AS q FROM (
        SELECT lang, item, sum(floor(share * 1000000 + 0.5)) / (any_value(texts) * 1000000.0::DOUBLE) AS share
        FROM firsts JOIN langs USING (lang) JOIN classes USING (rid) GROUP BY lang, item)
), word_mean AS (
    SELECT lang, item, sum(floor(n / n_words::DOUBLE * 1000000 + 0.5)) / (any_value(texts) * 1000000.0::DOUBLE) AS q
    FROM firsts JOIN langs USING (lang) JOIN counts USING (rid) GROUP BY lang, item
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY sum(floor(n / n_words::DOUBLE * 1000000 + 0.5)) DESC, item) <= 64
), asked AS (
    SELECT rid, n_words, l.lang AS ref FROM base JOIN langs l ON base.lang = l.lang WHERE n_words >= 50
), both_classes AS (
    SELECT rid, ref, share AS p, q FROM asked JOIN class_mean ON class_mean.lang = ref JOIN classes USING (rid, item)
), both_words AS (
    SELECT a.rid, ref, coalesce(n, 0) / n_words::DOUBLE AS p, q
    FROM asked a JOIN word_mean ON word_mean.lang = ref LEFT JOIN counts c ON c.rid = a.rid AND c.item = word_mean.item
), all_words AS (
    SELECT * FROM both_words
    UNION ALL
    SELECT rid, ref, greatest(1 - sum(p), 0), greatest(1 - sum(q), 0) FROM both_words GROUP BY rid, ref
), far AS (
    SELECT rid, min(x) FILTER (kind = 'c') AS class_distance, min(x) FILTER (kind = 'w') AS word_distance FROM (
        SELECT rid, ref, kind, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
                 + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS x
        FROM (SELECT *, 'c' AS kind FROM both_classes UNION ALL SELECT *, 'w' FROM all_words) GROUP BY rid, ref, kind)
    GROUP BY rid
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (class_distance IS NULL OR (class_distance <= 0.15 + 1.5 / sqrt(n_words) AND word_distance <= 0.35 + 0.9 / sqrt(n_words))) AS kept,
       round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance
FROM base LEFT JOIN far USING (rid)
"""


def op1_odd_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_recurrent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score(table(spark, sf_dir, "documents"))


#: Exact: all pairs that share a shingle, on full sets, then everything reachable.
OP1_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE len(w) WHEN 0 THEN [] WHEN 1 THEN w
        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), sets AS (
    SELECT doc_id, n, s FROM shingles JOIN sizes USING (doc_id)
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), both_ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(a, b) AS (
    SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b
), low AS (
    SELECT a, min(b) AS b FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low.b, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(low.b, doc_id)) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN low ON low.a = doc_id
"""


def op3_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_forest.near_duplicates(table(spark, sf_dir, "embeddings"))


#: Exact: all pairs of a label.
OP3_SQL = """
WITH RECURSIVE good AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.93
), reach(a, b) AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), low AS (
    SELECT a, min(b) AS b FROM reach GROUP BY a
), many AS (
    SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low.b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(low.b, vec_id)) AS kept
FROM embeddings LEFT JOIN low ON low.a = vec_id LEFT JOIN many ON many.a = vec_id
"""


def op4_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.rendered(table(spark, sf_dir, "conversations"))


OP4_SQL = r"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place,
           count(*) OVER (PARTITION BY conv_id) AS n
    FROM conversations
), prefixes AS (
    SELECT conv_id, place, n, role, text,
           string_agg(md5(role) || md5(text), '' ) OVER (PARTITION BY conv_id ORDER BY place) AS prefix
    FROM turns
), ends AS (
    SELECT min(conv_id) AS conv_id, prefix FROM prefixes WHERE place = n GROUP BY prefix
), kept AS (
    SELECT conv_id FROM ends WHERE prefix NOT IN (SELECT prefix FROM prefixes WHERE place < n)
)
SELECT p.conv_id, CAST((place - 1) // 64 AS INTEGER) AS part, count(*) AS n_turns,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY place) AS text
FROM prefixes p JOIN kept k ON p.conv_id = k.conv_id
GROUP BY p.conv_id, CAST((place - 1) // 64 AS INTEGER)
"""


def op5_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeats.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["length"])
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    rows = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 4096)


def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = sharding.shard_by_curve(docs, ["lang", "source", "n_chars"], 24)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


#: Verdict, host and path of the rules that ``op9_url_filter`` applies.
URL_RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


OP9_SQL = r"""
WITH parts AS (
    SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), split AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS h,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM parts
), named AS (
    SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM split
), rules(verdict, rhost, rpath) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fits AS (
    SELECT page_id, host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
           arg_max(verdict, length(rhost || rpath)) AS verdict
    FROM named LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
    GROUP BY page_id, host, path
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits
"""


def op11_exact_text_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_best_first_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


#: All phrases and all cuts, without growth or bounds.
OP12_SQL = r"""
WITH pieces AS (
    SELECT rid, lang, unnest(ps) AS piece, generate_subscripts(ps, 1) AS place FROM (
        SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang, regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps
        FROM documents)
), words AS (
    SELECT rid, place, lang, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos
    FROM (SELECT rid, place, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces)
), grams AS (
    SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4
    FROM words WINDOW o AS (PARTITION BY rid, place ORDER BY pos)
), f AS (
    SELECT lang, p, count(*) AS a FROM (
        SELECT lang, [w1] AS p FROM grams
        UNION ALL SELECT lang, [w1, w2] FROM grams WHERE w2 IS NOT NULL
        UNION ALL SELECT lang, [w1, w2, w3] FROM grams WHERE w3 IS NOT NULL
        UNION ALL SELECT lang, [w1, w2, w3, w4] FROM grams WHERE w4 IS NOT NULL)
    GROUP BY lang, p HAVING count(*) >= 30
), candidates AS (
    SELECT * FROM f WHERE len(p) > 1
), cuts AS (
    SELECT c.lang, c.p, c.a, k, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a) // (x.a + y.a) AS score
    FROM (SELECT *, unnest(range(1, len(p))) AS k FROM candidates) c
    JOIN f x ON x.lang = c.lang AND x.p = c.p[1:k] JOIN f y ON y.lang = c.lang AND y.p = c.p[k + 1:]
), scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), inside AS (
    SELECT lang, p[i:j] AS p, max(a) AS longer
    FROM (SELECT lang, p, a, i, unnest(range(i + 1, len(p) + 1)) AS j FROM (SELECT *, unnest(range(1, len(p))) AS i FROM candidates))
    WHERE j - i + 1 < len(p) GROUP BY ALL
), kept AS (
    SELECT s.*, array_to_string(s.p, ' ') AS phrase FROM scored s LEFT JOIN inside USING (lang, p)
    WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
)
SELECT lang, row_number() OVER o AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM kept JOIN (SELECT lang, count(*) AS n FROM words GROUP BY lang) USING (lang)
WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER o <= 2000
"""


def op13_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return pruned_graph.nearest(rows, rows.where("vec_id % 50 = 0"), 5)


#: The exact lists, which the beams are to find. Sums run in the order of the components on both sides.
OP13_SQL = """
WITH good AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_dot_product(q.v, c.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(c.v, c.v))) AS score
    FROM good q JOIN good c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(row_number() OVER o AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW o AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER o <= 5
"""


QUERIES = {
    "op2_recurrent_scores": (op2_recurrent_scores, None),
    "op3_projection_forest": (op3_projection_forest, OP3_SQL),
    "op5_suffix_repeats": (op5_suffix_repeats, None),
    "op1_odd_sketch_dedup": (op1_odd_sketch_dedup, OP1_SQL),
    "op6_byte_bpe": (op6_byte_bpe, None),
    "op4_snapshot_collapse": (op4_snapshot_collapse, OP4_SQL),
    "op7_best_fit_packing": (op7_best_fit_packing, None),
    "op8_hilbert_shards": (op8_hilbert_shards, None),
    "op9_url_filter": (op9_url_filter, OP9_SQL),
    "op10_quality_rules": (op10_quality_rules, OP10_SQL),
    "op11_exact_text_alignment": (op11_exact_text_alignment, None),
    "op12_best_first_phrases": (op12_best_first_phrases, OP12_SQL),
    "op13_pruned_graph": (op13_pruned_graph, OP13_SQL),
}
