"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismtab.llm import chat, decontaminate, digests, divergence, html, language, mixing, negatives, ngrams, pieces, sharding, simhash, substrings

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_sharding")
def op2(spark, sf_dir):
    """Whole documents dealt to 40 shards; the digest columns come from the dealt rows."""
    dealt = sharding.shard_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), 40, seed=20)
    return dealt.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op9_simhash_near_dedup")
def op9(spark, sf_dir):
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", shingle=4, distance=4)
    return found.select(
        F.col("key").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


@query(
    "op5_substring_dedup",
    f"""WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
  win AS (SELECT doc_id, i, array_to_string(ws[i : i + 49], ' ') AS s FROM w, unnest(range(1, len(ws) - 48)) u(i)),
  low AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
  gone AS (SELECT DISTINCT doc_id, i + k AS p FROM win JOIN low USING (s), range(50) r(k) WHERE m < doc_id),
  word AS (SELECT doc_id, p, ws[p] AS x FROM w, unnest(range(1, len(ws) + 1)) u(p)),
  kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id""",
)
def op5(spark, sf_dir):
    """Words left after the removal of repeated 50-word windows."""
    left = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", size=50)
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op3_decontamination")
def op3(spark, sf_dir):
    """One row per document and benchmark item that overlap."""
    found = decontaminate.overlaps(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", F.col("m.item").alias("item_id"), "m.matched", "m.item_tokens", "m.first_token", "m.last_token")


#: the vocabulary file, a parameter of the queries
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@query("op1_sentencepiece")
def op1(spark, sf_dir):
    """Piece ids of every whole document, and whether they decode to its text."""
    coded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), PIECES, decoded="decoded")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


@query("op7_language_id")
def op7(spark, sf_dir):
    """Language of every document: text, declared language and the priors of its source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    found = language.identify(docs, "text", F.col("lang"), F.col("source"), label="lang")
    return found.select("doc_id", "language", F.round("probability", 6).alias("probability"), "accepted")


@query("page_language")
def page_language(spark, sf_dir):
    """The same for web pages: markup language, address suffix and host; the text model is that of the documents."""
    pages = table(spark, sf_dir, "pages")
    plain = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>", " "), r"<[^>]*>|&[a-zA-Z#0-9]+;?", " ")
    rows = pages.select("page_id", "url", plain.alias("text"), language.declared_of(F.col("html")).alias("declared"))
    model = language.fit(table(spark, sf_dir, "documents"), "text", "lang")
    found = language.identify(rows, "text", F.col("declared"), F.col("url"), model=model)
    return found.select("page_id", "url", "language", F.round("probability", 6).alias("probability"), "accepted")


#: the pages' own markup: an article of h1 and p with b and br
ARTICLE = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|\z)', 1) AS x FROM pages),
  b AS (SELECT page_id, url, list_filter(list_transform(string_split_regex(x, '</?(p|h1)>'), lambda y:
      trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace(replace(y, '<br>', ' '),
        '<[^>]*(>|\z)', '', 'g'), '&#39;', ''''), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))),
      lambda y: y <> '') AS t FROM a)
SELECT page_id, url, array_to_string(t, chr(10) || chr(10)) AS text, CAST(length(array_to_string(t, chr(10) || chr(10))) AS BIGINT) AS n_chars FROM b"""


@query("op10_html_extraction", ARTICLE)
def op10(spark, sf_dir):
    """Main text of every page, without what its site repeats."""
    found = html.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op8_document_fingerprints")
def op8(spark, sf_dir):
    """Digests of every document and of its edited text, with their likeness and that to the next document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranks = digests.entropy_ranks(docs)
    rows = digests.with_next(docs).withColumn("n_chars", F.length("text"))
    cut = F.expr("n_chars div 3").cast("int")
    rows = rows.withColumn("edited", F.concat(F.substr("text", F.lit(1), F.col("n_chars") - cut), F.substr("next_text", F.lit(1), cut)))
    made = digests.fingerprints(rows, {"text": "fingerprint", "edited": "edited_fingerprint", "next_text": "next_fingerprint"}, ranks)
    return made.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        digests.likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        digests.likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )


#: lengths as the template gives them: a backslash for each control string and each backslash inside a text
TURNS = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, length(regexp_replace(text, '(<</TEXT>>|<</SYS>>|<<ROLE>>|<<TEXT>>|<<SYS>>|\[/INST\]|\[INST\]|<unk>|</s>|<s>|\\)', '\1+', 'g'))
  + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 25 + length(role) END AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text))) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, md5(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id"""


@query("op6_chat_formatting", TURNS)
def op6(spark, sf_dir):
    """Every conversation (and one of control strings) folded from its events, rendered and read back."""
    own = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], "conv_id long, turn long, role string, text string"))
    rendered = chat.conversations(chat.events_of(turns), ["seq", "part"])
    return chat.read_back(rendered).withColumnRenamed("conversation", "conv_id")


#: the order of the scoring model, a parameter of the query
ORDER = 3


@query("op4_lm_scoring")
def op4(spark, sf_dir):
    """Scores of every document under a model of the nine tenths that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0)
    model = ngrams.train(docs.where("not held_out"), order=ORDER)
    return ngrams.score(docs, model).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


#: every share as an integer; pairs are summed over all kept terms
DIVERGENCE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
  w AS (SELECT r, lang, source, unnest(ts) AS t FROM d),
  keep AS (SELECT lang, t FROM w GROUP BY lang, t HAVING count(DISTINCT r) >= 10),
  g AS (SELECT DISTINCT lang, source FROM d),
  v AS (SELECT lang, count(*) AS v FROM keep GROUP BY lang),
  c AS (SELECT lang, source, t, count(*) AS c FROM w JOIN keep USING (lang, t) GROUP BY lang, source, t),
  n AS (SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source),
  p AS (SELECT n.lang, n.source, keep.t, coalesce(c, 0) AS c, CAST(1 + (1000000000 * (coalesce(c, 0) + 2)) // (n + 2 * v) AS BIGINT) AS p
    FROM n JOIN v USING (lang) JOIN keep USING (lang) LEFT JOIN c ON c.lang = n.lang AND c.source = n.source AND c.t = keep.t),
  l AS (SELECT lang, t, CAST(1 + (1000000000 * (sum(c) + 2)) // (any_value(tn) + 2 * any_value(v)) AS BIGINT) AS q
    FROM c JOIN v USING (lang) JOIN (SELECT lang, sum(n) AS tn FROM n GROUP BY lang) USING (lang) GROUP BY lang, t),
  pair AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce((SELECT sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) FROM p x JOIN p y
      ON x.lang = y.lang AND x.t = y.t WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
  term AS (SELECT lang, source, t AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p JOIN l USING (lang, t) WHERE c > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM pair
UNION ALL SELECT * FROM (SELECT lang, source, 'term' AS part, item, value,
  CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM term) WHERE rank <= 10"""


@query("op11_source_divergence", DIVERGENCE)
def op11(spark, sf_dir):
    """Distances of all sources of a language, and the terms that set each source apart."""
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


NEGATIVES = """
WITH e AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS own, CAST(list_inner_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
    FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
  p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE own
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT own AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 3"""


@query("op12_hard_negatives", NEGATIVES)
def op12(spark, sf_dir):
    """Negatives of every fiftieth vector, just below each of its best positives."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), label=label)


#: the same laws written out: the level by full sources, seats by ranking all quotients near the quota
MIXING = f"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size, md5('13:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS o FROM documents),
  s AS (SELECT source, CAST(sum(size) AS BIGINT) AS s, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM d GROUP BY source),
  w AS (SELECT *, [5, 2, 1][(i - 1) % 3 + 1] AS w, 3 * s AS most, CAST(sum(s) OVER () AS BIGINT) AS total FROM s),
  lv AS (SELECT *, (total - coalesce(CAST(sum(most) OVER b AS BIGINT), 0)) / (CAST(sum(w) OVER () AS BIGINT) - coalesce(CAST(sum(w) OVER b AS BIGINT), 0)) AS lv
    FROM w WINDOW b AS (ORDER BY most / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  t AS (SELECT *, least(CAST(most AS DOUBLE), w * max(lv) OVER ()) AS target FROM lv),
  k AS (SELECT *, greatest(1, least(1024, coalesce(CAST(floor(min(target) FILTER (target > 0) OVER () / 256) AS BIGINT), 1))) AS block FROM t),
  h AS (SELECT k.*, j, ((total // block) * j) // 40 AS h FROM k, range(1, 41) r(j)),
  seat AS (SELECT i, j, h, seat, target / (2 * seat + 1) AS quotient FROM h, unnest(range(0, CAST(least(most // block, ceil(h * target / greatest(total, 1)) + 30) AS BIGINT))) u(seat)),
  won AS (SELECT i, j FROM seat QUALIFY row_number() OVER (PARTITION BY j ORDER BY quotient DESC, i, seat) <= h),
  e AS (SELECT i, list(n ORDER BY j) AS ends FROM (SELECT k.i, r.j, count(won.i) AS n FROM k CROSS JOIN range(1, 41) r(j) LEFT JOIN won ON won.i = k.i AND won.j = r.j GROUP BY k.i, r.j) GROUP BY i),
  l AS (SELECT d.*, k.s, k.target, k.block, ends, CAST(sum(size) OVER (PARTITION BY k.i ORDER BY o, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS a
    FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source JOIN e ON e.i = k.i),
  piece AS (SELECT l.*, j, greatest(0, least(a + size + c * s, ends[j] * block) - greatest(a + c * s, CASE j WHEN 1 THEN 0 ELSE ends[j - 1] END * block)) AS n
    FROM l, range(3) r(c), range(1, 41) q(j))
SELECT doc_id, size, any_value(s) AS source_size, any_value(target) AS target, CAST(sum(n) AS BIGINT) AS taken,
  CAST(coalesce(min(j - 1) FILTER (n > 0), -1) AS INT) AS first_shard, CAST(count(*) FILTER (n > 0) AS INT) AS pieces FROM piece GROUP BY doc_id, size, a, o, source"""


@query("op13_mixing", MIXING)
def op13(spark, sf_dir):
    """Words of every document that a mix by source weights takes, over 40 shards."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), mixing.word_count(F.col("text")))
    first = F.coalesce(F.array_min(F.transform("pieces", lambda p: p["shard"])), F.lit(-1)).alias("first_shard")
    return mixed.select("doc_id", "size", "source_size", "target", "taken", first, F.size("pieces").alias("pieces"))
