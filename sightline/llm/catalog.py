"""The registered queries of the pipeline operators: thin digests over them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Lower-cased A-Z and words of the two kinds, in DuckDB.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_BLANK = f"regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+')"


@query("op3_token_counts")
def op3(spark, sf_dir):
    from . import token_counts as TC
    got = TC.over_limit(TC.count_tokens(table(spark, sf_dir, "documents")), 4096)
    return got.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op10_decontaminate", f"""
WITH docs AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
items AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, list_slice(w, i, i + least(10, len(w)) - 1) AS win
            FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(win) AS n FROM windows),
spots AS (SELECT d.doc_id, i, n, list_slice(d.w, i, i + n - 1) AS win
          FROM docs d, sizes, unnest(range(1, len(d.w) - n + 2)) AS t(i)),
found AS (SELECT s.doc_id, s.i, s.n, x.item_id FROM spots s JOIN windows x ON s.win = x.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items,
                 sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found
                WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
       coalesce(m.n_items, 0) AS n_items, coalesce(m.items_sha256, sha256('')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h USING (doc_id) LEFT JOIN named m USING (doc_id)
""")
def op10(spark, sf_dir):
    from . import decontaminate as D
    got = D.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@query("op9_pack")
def op9(spark, sf_dir):
    from . import packing as P
    return P.pack(table(spark, sf_dir, "documents"))


@query("op4_near_duplicates")
def op4(spark, sf_dir):
    from . import minhash as M
    return M.groups(table(spark, sf_dir, "documents"))


@query("op6_licenses")
def op6(spark, sf_dir):
    from . import licenses as L
    return L.summary(L.scan(table(spark, sf_dir, "documents")))


@query("op7_language")
def op7(spark, sf_dir):
    from . import langid as G
    docs = table(spark, sf_dir, "documents")
    model = G.train(docs, G.learnable("doc_id", "lang"))
    out = F.coalesce(G.held_out_digit("doc_id") == 2, F.lit(False))
    return G.identify(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query("op5_hidden_markov")
def op5(spark, sf_dir):
    from . import hmm as H
    return H.score(table(spark, sf_dir, "documents"))


@query("op8_main_text")
def op8(spark, sf_dir):
    from . import wrappers as W
    return W.extract(table(spark, sf_dir, "pages"))


@query("op2_nearest")
def op2(spark, sf_dir):
    from . import nndescent as N
    return N.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query("op11_toxicity")
def op11(spark, sf_dir):
    from . import toxicity as X
    docs = table(spark, sf_dir, "documents")
    model = X.train(docs, table(spark, sf_dir, "labels"))
    out = F.coalesce(X.held_out_digit("doc_id") == 2, F.lit(False))
    got = X.score(docs, model)
    return got.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
                      "n_sentences", "n_offending", "worst_start", "worst_length")


@query("op13_alignment")
def op13(spark, sf_dir):
    from . import alignment as A
    return A.align(table(spark, sf_dir, "documents"))


_PIECES = f"regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')"


@query("op12_phrases", f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w
                FROM (SELECT lang, unnest({_PIECES}) AS p FROM documents)),
totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
grams AS (SELECT lang, k, g, count(*) AS a
          FROM (SELECT lang, k, list_slice(w, i, i + k - 1) AS g
                FROM pieces, unnest(range(1, 6)) AS s(k), unnest(range(1, len(w) - k + 2)) AS t(i))
          GROUP BY lang, k, g HAVING count(*) >= 100),
inside AS (SELECT DISTINCT x.lang, list_slice(x.g, i, i + m - 1) AS g, x.a
           FROM grams x, unnest(range(2, x.k)) AS s(m), unnest(range(1, x.k - m + 2)) AS t(i)),
longest AS (SELECT lang, g, max(a) AS most FROM inside GROUP BY lang, g),
cuts AS (SELECT x.lang, x.g, x.a, c, list_slice(x.g, 1, c) AS head, list_slice(x.g, c + 1, x.k) AS rest
         FROM grams x LEFT JOIN longest y ON x.lang = y.lang AND x.g = y.g, unnest(range(1, x.k)) AS s(c)
         WHERE x.k >= 2 AND coalesce(y.most, 0) < x.a),
scored AS (SELECT c.lang, c.g, c.a, c.c, h.a AS l, r.a AS r, t.n,
                  (1000::HUGEINT * c.a * t.n) // (h.a::HUGEINT * r.a) AS score
           FROM cuts c JOIN grams h ON h.lang = c.lang AND h.g = c.head JOIN grams r ON r.lang = c.lang AND r.g = c.rest
                JOIN totals t ON t.lang = c.lang),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
grown AS (SELECT lang, list_slice(g, 1, k - 1) AS g, a AS right_most, 0 AS left_most FROM grams WHERE k > 2
          UNION ALL SELECT lang, list_slice(g, 2, k), 0, a FROM grams WHERE k > 2),
sides AS (SELECT lang, g, max(left_most) AS left_most, max(right_most) AS right_most FROM grown GROUP BY lang, g),
ranked AS (SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, array_to_string(w.g, ' ')) AS rank,
                  array_to_string(w.g, ' ') AS phrase, a, l, r, n, score, left_most, right_most
           FROM weakest w LEFT JOIN sides s ON s.lang = w.lang AND s.g = w.g)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score,
       CAST(coalesce(left_most, 0) AS BIGINT) AS left_most, CAST(coalesce(right_most, 0) AS BIGINT) AS right_most
FROM ranked WHERE rank <= 2000
""")
def op12(spark, sf_dir):
    from . import phrases as P
    return P.collocations(table(spark, sf_dir, "documents"))


# The audited archive: pages as WARC records in files of 256 page ids, and a
# replica with damage placed by a rule on the id.
_RECORD = r"""
    'WARC/1.1' || e || 'WARC-Type: resource' || e || 'WARC-Record-ID: <urn:page:' ||
    coalesce(CAST(page_id AS VARCHAR), '') || '>' || e || 'WARC-Target-URI: ' || coalesce(url, '') || e ||
    'Content-Type: text/html' || e || 'Content-Length: ' || strlen(coalesce(html, '')) || e || e ||
    coalesce(html, '') || e || e"""


@query("op1_fixity_audit", f"""
WITH r AS (SELECT page_id, url, {_RECORD} AS payload FROM pages, (SELECT chr(13) || chr(10) AS e)),
a AS (SELECT page_id, payload, page_id // 256 AS file,
             coalesce(sum(strlen(payload)) OVER (PARTITION BY page_id // 256 ORDER BY page_id, url, payload
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset" FROM r),
b AS (SELECT *, CASE page_id % 97 WHEN 3 THEN 'X' || substr(payload, 2)
                     WHEN 5 THEN substr(payload, 1, length(payload) // 2) ELSE payload END AS copy
      FROM a WHERE page_id % 97 <> 7 OR page_id IS NULL),
h AS (SELECT a.file, a."offset", a.page_id AS record_id, strlen(a.payload) AS length_a, strlen(b.copy) AS length_b,
             sha256(a.payload) AS digest_a, sha256(b.copy) AS digest_b
      FROM a LEFT JOIN b ON a.file = b.file AND a."offset" = b."offset")
SELECT file, CAST("offset" AS BIGINT) AS "offset", record_id,
       CASE WHEN digest_b IS NULL THEN 'missing' ELSE 'changed' END AS status, length_a, length_b, digest_a, digest_b
FROM h WHERE digest_a IS DISTINCT FROM digest_b
""")
def op1(spark, sf_dir):
    from pyspark.sql import Window

    from . import merkle as M
    pages = table(spark, sf_dir, "pages")
    page = F.col("page_id")
    rows = pages.select(page, "url", M.warc_record(page, F.col("url"), F.col("html")).alias("payload"),
                        F.floor(page / 256).alias("file"))
    # offsets from sizes alone: the payloads do not take part in the sort
    place = Window.partitionBy("file").orderBy("page_id", "url", "payload").rowsBetween(Window.unboundedPreceding, -1)
    first = rows.withColumn("offset", F.coalesce(F.sum(F.octet_length("payload")).over(place), F.lit(0)))
    k = F.pmod(page, F.lit(97))
    copy = (F.when(k == 3, F.concat(F.lit("X"), F.substring("payload", 2, 2**31 - 1)))
            .when(k == 5, F.substr("payload", F.lit(1), F.floor(F.char_length("payload") / 2).cast("int")))
            .otherwise(F.col("payload")))
    second = first.where((k != 7) | page.isNull()).withColumn("payload", copy)
    return M.audit(first, second, id_col="page_id")
