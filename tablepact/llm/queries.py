"""The registered queries of these operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_pipeline import run, vocabulary

from ..sources.staging import new_path
from .common import table
from .embedding_dedup import near_vectors
from .hamming_search import nearest
from .html_text import main_text
from .mixing import schedule
from .ngram_join import jaccard_join
from .packing import pack
from .pseudonyms import pseudonymise
from .quality import held_out, score, train
from .secret_scan import scan
from .sentence_pieces import decode, encode
from .spelling_variants import variants
from .token_codes import read_tokens, write_tokens
from .whitening import whiten


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


_VALID = """v AS (SELECT vec_id, embedding::DOUBLE[] AS e, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS n
FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
AND len(list_filter(embedding, lambda x: x <> 0)) > 0)"""


@query
def op1_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_vectors(table(spark, sf, "embeddings")).withColumnRenamed("id", "vec_id")


ORACLES["op1_embedding_dedup"] = f"""WITH RECURSIVE {_VALID},
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
WHERE list_inner_product(a.e, b.e) / a.n / b.n >= 0.95),
r AS (SELECT vec_id AS id, vec_id AS root FROM embeddings UNION SELECT p.b, r.root FROM r JOIN p ON p.a = r.id WHERE r.root < p.b),
c AS (SELECT id, min(root) AS component_id FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.id = e.vec_id LEFT JOIN n ON n.a = e.vec_id"""


@query
def op10_hamming_search(spark: SparkSession, sf: str) -> DataFrame:
    found = nearest(table(spark, sf, "embeddings"), F.col("id") % 100 == 0, k=10)
    return found.withColumnRenamed("id", "vec_id")


@query
def op2_token_codes(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "tokens")
    write_tokens(table(spark, sf, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op7_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json")).drop("ids")


@query
def op3_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return scan(table(spark, sf, "documents"))


@query
def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = train(docs, table(spark, sf, "labels"))
    return score(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op9_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return schedule(docs).select("doc_id", "size", "source_size", "target", "taken", "positions")


#: A table of (doc_id, source, size) to what the mix takes of it.
MIX_SQL = """by_source AS (SELECT source, sum(size) AS source_size FROM sized GROUP BY source),
turns AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn, (3 * source_size)::DOUBLE AS cap FROM by_source),
weighted AS (SELECT *, (turn % 3 + 1)::DOUBLE AS weight FROM turns),
levels AS (SELECT *, (SELECT sum(source_size) FROM by_source)::DOUBLE
- coalesce(sum(cap) OVER (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
sum(weight) OVER (ORDER BY cap / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS among FROM weighted),
tested AS (SELECT *, cap * among <= rest * weight AS capped FROM levels),
level AS (SELECT rest, among FROM tested WHERE NOT capped ORDER BY cap / weight, turn LIMIT 1),
targets AS (SELECT t.source, t.source_size, CASE WHEN capped OR l.rest IS NULL THEN cap ELSE weight * l.rest / l.among END AS target
FROM tested t LEFT JOIN level l ON true),
placed AS (SELECT s.*, t.source_size, t.target, coalesce(sum(size) OVER (PARTITION BY s.source
ORDER BY coalesce(md5(doc_id::VARCHAR), ''), doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
mixed AS (SELECT *, (greatest(0, least(size, floor(target) - before)) + greatest(0, least(size, floor(target) - before - source_size))
+ greatest(0, least(size, floor(target) - before - 2 * source_size)))::BIGINT AS taken FROM placed)"""
#: Continues it: each pass's place in training, by the source's ramp.
RAMPS_SQL = """ramps AS (SELECT source, [-0.5, 0, 0.5][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS k
FROM targets WHERE floor(target) >= 1)"""
PASSES_SQL = RAMPS_SQL + """,
passes AS (SELECT m.doc_id, copy, k, greatest(0, least(size, floor(target) - before - copy * source_size)) AS words,
(copy * source_size + before + words / 2) / floor(target) AS share
FROM mixed m JOIN ramps r ON m.source IS NOT DISTINCT FROM r.source, range(3) c(copy)),
ordered AS (SELECT doc_id, copy, CASE WHEN k = 0 THEN share ELSE (sqrt((1 - k) * (1 - k) + 4 * k * share) - (1 - k)) / (2 * k) END AS position
FROM passes WHERE words > 0)"""
ORACLES["op9_mixing"] = rf"""WITH sized AS (SELECT doc_id, source,
coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
{MIX_SQL},
{RAMPS_SQL},
shared AS (SELECT m.*, k, list_transform(list_filter([0, 1, 2], lambda c: floor(target) - before - c * source_size > 0 AND size > 0),
lambda c: (c * source_size + before + greatest(0, least(size, floor(target) - before - c * source_size)) / 2) / floor(target)) AS shares
FROM mixed m LEFT JOIN ramps r ON m.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target, taken, list_transform(shares, lambda s: CASE WHEN k = 0 THEN s
ELSE (sqrt((1 - k) * (1 - k) + 4 * k * s) - (1 - k)) / (2 * k) END) AS positions FROM shared"""


@query
def op5_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return main_text(table(spark, sf, "pages"))


@query
def op6_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    return pseudonymise(table(spark, sf, "documents"), key=b"an example key, not a secret")


@query
def op8_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join(table(spark, sf, "documents"))


#: Classes of equal shingle sets are joined on shared shingles; components follow by recursion.
JOIN_SQL = r"""words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM input),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
classes AS (SELECT min(doc_id) AS id, list_sort(s) AS s, len(min(s)) AS n FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
grams AS (SELECT id, n, unnest(s) AS g FROM classes),
p AS (SELECT a.id AS a, b.id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.id < b.id
GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT id, id AS root FROM classes UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id WHERE r.root < e.b),
roots AS (SELECT id, min(root) AS root FROM r GROUP BY id),
joined AS (SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(t.root, s.doc_id) AS component_id
FROM sets s LEFT JOIN classes c ON c.s = list_sort(s.s) LEFT JOIN roots t ON t.id = c.id)"""
ORACLES["op8_ngram_join"] = f"""WITH RECURSIVE input AS (SELECT doc_id, text FROM documents),
{JOIN_SQL}
SELECT doc_id, n_shingles, component_id FROM joined"""


@query
def op11_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whiten(table(spark, sf, "embeddings"), components=16)


@query
def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return variants(table(spark, sf, "documents"))


#: CRC-32 by its polynomial; near words share what is left of them without one letter, at the same place or against the whole.
ORACLES["op12_spelling_variants"] = r"""WITH RECURSIVE
polynomial AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS t),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM runs WHERE length(run) >= 6 GROUP BY ALL),
sums AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::INT, 2))::BIGINT)),
lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM counted, polynomial),
found AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run) + 2)::INT) ELSE run END AS word, n FROM sums),
words AS (SELECT word, sum(n)::BIGINT AS n FROM found WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
pairs AS (SELECT a.word AS a, b.word AS b FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
UNION SELECT a.word, b.word FROM words a JOIN less b ON a.word = b.rest UNION SELECT b.word, a.word FROM words a JOIN less b ON a.word = b.rest),
ranked AS (SELECT p.a, p.b, w.n, count(*) OVER (PARTITION BY p.a) AS n_near, row_number() OVER (PARTITION BY p.a ORDER BY w.n DESC, p.b) AS k FROM pairs p JOIN words w ON w.word = p.b),
forms AS (SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 5 * w.n THEN r.b END AS form, CASE WHEN r.n >= 5 * w.n THEN r.n END AS form_n
FROM words w LEFT JOIN ranked r ON r.a = w.word AND r.k = 1),
chain AS (SELECT word, word AS at, form AS next FROM forms UNION ALL SELECT c.word, c.next, f.form FROM chain c JOIN forms f ON f.word = c.next)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL"""


@query
def op13_sentence_pieces(spark: SparkSession, sf: str) -> DataFrame:
    path = vocabulary("piece_bpe_32k.model")
    coded = encode(table(spark, sf, "documents").select("doc_id", "text"), path).drop("text")
    return decode(coded, path).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return run(spark, sf)
