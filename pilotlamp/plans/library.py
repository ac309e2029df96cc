"""Queries: documents, chunks and vector search."""

from pyspark.sql import functions as F

from pilotlamp import vocab
from pilotlamp.functions import similarity, text
from pilotlamp.operators import corpus as D
from pilotlamp.plans.registry import Tables, query

_WS = r"[\s\x0b\x{85}\p{Z}]"


def _strip(sql: str) -> str:
    return f"regexp_replace(regexp_replace({sql}, '^{_WS}+', ''), '{_WS}+$', '')"


_CLEAN = _strip("regexp_replace(regexp_replace(translate(text, chr(160) || chr(12288) || chr(13), '  ' || chr(10)), "
                       "'[ \t]+', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g')")
_CHUNKED = f"""
    WITH p AS (SELECT doc_id, lang, source, list_filter(list_transform(regexp_split_to_array({_CLEAN}, '\\n+'), lambda x: {_strip('x')}), lambda x: x <> '') AS paras FROM {{documents}}),
    k AS (SELECT *, list_reduce(paras, lambda acc, x: CASE WHEN length(split_part(acc, chr(30), -1)) + length(x) + 1 <= 700
        THEN acc || chr(10) || x ELSE acc || chr(30) || x END) AS packed FROM p WHERE len(paras) > 0),
    s AS (SELECT doc_id, lang, source, unnest(string_split(packed, chr(30))) AS seg, unnest(generate_series(1, len(string_split(packed, chr(30))))) AS si FROM k),
    c AS (SELECT doc_id, lang, source, si, st, CASE WHEN length(seg) <= 700 THEN seg ELSE {_strip('substr(seg, CAST(st * 580 + 1 AS BIGINT), 700)')} END AS chunk FROM (
        SELECT *, unnest(generate_series(0, CASE WHEN length(seg) <= 700 THEN 0 ELSE CAST(ceil((length(seg) - 700) / 580) AS BIGINT) END)) AS st FROM s)),
    chunked AS (SELECT doc_id, lang, source, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY si, st) - 1 AS INTEGER) AS chunk_index, chunk FROM c WHERE chunk <> '')
"""


def _chunked(t: Tables):
    return D.chunk_documents(t.documents.select("doc_id", "lang", "source", "text"))


@query("w15_document_chunks", _CHUNKED + """
    SELECT doc_id, chunk_index, md5(chunk) AS chunk, sha1(concat(CAST(doc_id AS VARCHAR), '||', lang, '||', source, '||', CAST(chunk_index AS VARCHAR), '||', chunk)) AS id FROM chunked""")
def w15(t: Tables):
    return _chunked(t).select("doc_id", "chunk_index", F.md5("chunk").alias("chunk"), "id")


@query("a19_corpus_stats", _CHUNKED + """
    SELECT lang, count(*) AS chunks, count(DISTINCT doc_id) AS source_files, CAST(sum(length(chunk)) AS BIGINT) AS chars FROM chunked GROUP BY lang""")
def a19(t: Tables):
    return D.corpus_stats(_chunked(t), ["lang"], "doc_id")


@query("a19_corpus_manifest", _CHUNKED + """
    SELECT doc_id, chunk_index, length(chunk) AS chars, replace(substr(chunk, 1, 120), chr(10), ' ') AS preview FROM chunked""")
def a19_manifest(t: Tables):
    return D.manifest(_chunked(t), preview=120).select("doc_id", "chunk_index", "chars", "preview")


@query("f19_content_ids", "SELECT doc_id, sha1(concat(lang, '||', source, '||', CAST(n_chars AS VARCHAR), '||', text)) AS id FROM {documents}")
def f19(t: Tables):
    return t.documents.select("doc_id", text.content_id(F.col("lang"), F.col("source"), F.col("n_chars"), F.col("text")).alias("id"))


@query("src11_chunk_upsert", """
    SELECT page_id AS id, CASE WHEN page_id % 3 = 0 THEN concat(url, '#2') ELSE url END AS url, CASE WHEN page_id % 3 = 0 THEN 2 ELSE 1 END AS version FROM {pages}
    UNION ALL SELECT page_id + 1000000, url, 2 FROM {pages} WHERE page_id % 5 = 0""")
def src11(t: Tables):
    old = t.pages.select(F.col("page_id").alias("id"), "url", F.lit(1).alias("version"))
    again = t.pages.filter("page_id % 3 = 0").select(F.col("page_id").alias("id"), F.concat("url", F.lit("#2")).alias("url"), F.lit(2).alias("version"))
    fresh = t.pages.filter("page_id % 5 = 0").select((F.col("page_id") + 1000000).alias("id"), "url", F.lit(2).alias("version"))
    return D.upsert(old, again.unionByName(fresh))


_WINDOWS = f"""
    WITH v AS (SELECT unnest([{", ".join(f"'{w.lower()}'" for w in vocab.EVIDENCE_WORDS)}]) AS word),
    p AS (SELECT doc_id, text, word, string_split(lower(text), word) AS parts FROM {{documents}}, v),
    pos AS (SELECT DISTINCT doc_id, text, CAST(list_sum(list_transform(parts[1:k], lambda x: length(x))) + (k - 1) * length(word) AS BIGINT) AS i
      FROM (SELECT *, unnest(generate_series(1, len(parts) - 1)) AS k FROM p)),
    win AS (SELECT doc_id, i, {_strip("regexp_replace(substring(text, greatest(0, i - 1000) + 1, i + 1000 - greatest(0, i - 1000)), '\\n{3,}', '\n\n', 'g')")} AS w FROM pos),
    f AS (SELECT doc_id, w, min(i) AS i FROM win WHERE w <> '' GROUP BY doc_id, w)"""


@query("f29_evidence_windows", _WINDOWS + """
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS place, length(w) AS chars, md5(w) AS "window" FROM f""")
def f29(t: Tables):
    w = t.documents.select("doc_id", F.posexplode(D.evidence_windows(F.col("text"))).alias("place", "window"))
    return w.select("doc_id", "place", F.length("window").alias("chars"), F.md5("window").alias("window"))


@query("w16_evidence_batches", _WINDOWS.replace("WITH v", "WITH RECURSIVE v") + """,
    n AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS r, length(w) AS c FROM f),
    walk AS (
      SELECT doc_id, r, 0 AS batch, c AS chars FROM n WHERE r = 1
      UNION ALL
      SELECT n.doc_id, n.r, CASE WHEN chars + c + 1 <= 15000 THEN batch ELSE batch + 1 END,
             CASE WHEN chars + c + 1 <= 15000 THEN chars + 2 + c ELSE c END FROM walk JOIN n ON n.doc_id = walk.doc_id AND n.r = walk.r + 1
    )
    SELECT doc_id, batch, max(chars) AS chars FROM walk GROUP BY doc_id, batch""")
def w16(t: Tables):
    w = t.documents.select("doc_id", D.batch_windows(D.evidence_windows(F.col("text"))).alias("b"))
    return w.select("doc_id", F.posexplode("b").alias("batch", "body")).select("doc_id", "batch", F.length("body").alias("chars"))


_TERM = "PWR|POWER|RUN|ALM|ALARM|ACT|ACTIVE|LINK|LNK|LOS|FAIL|FAULT|STATUS|STA\\d*|COM|SYS|SYSTEM|NET|LAN|WAN|RX|TX|ONLINE|BYPASS|BAT|BATTERY"


@query("f30_indicator_terms", f"""
    WITH l AS (SELECT page_id, {_strip("regexp_replace(unnest(string_split(html, chr(10))), '" + _WS + "+', ' ', 'g')")} AS line FROM {{pages}}),
    h AS (SELECT DISTINCT page_id, unnest(list_transform(regexp_extract_all(line, '(?i)({_TERM})'), lambda x: upper(x))) AS keyword, substr(line, 1, 120) AS manual_text
      FROM l WHERE line <> '' AND length(line) <= 240),
    w AS (SELECT page_id, unnest(list_filter(['PWR','POWER','RUN','ALM','ALARM','ACT','ACTIVE','LINK','LNK','LOS','FAIL','FAULT','STATUS','STA','COM','SYS','SYSTEM','NET','LAN','WAN','RX','TX','ONLINE','BYPASS','BAT','BATTERY'],
      lambda k: contains(upper(html), k))) AS keyword FROM {{pages}})
    SELECT * FROM h UNION ALL SELECT page_id, keyword, keyword FROM w WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.page_id = w.page_id AND h.keyword = w.keyword)""")
def f30(t: Tables):
    return D.indicator_terms(t.pages, "page_id", "html", longest=240, kept_chars=120)


@query("f28_cosine_distance", """
    SELECT a.vec_id, round(1 - list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS distance
    FROM {embeddings} a JOIN {embeddings} b ON b.vec_id = a.vec_id + 1""")
def f28(t: Tables):
    after = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return t.embeddings.join(after, "vec_id").select(
        "vec_id", F.round(similarity.cosine_distance(F.col("embedding"), F.col("other")), 6).alias("distance"))


_KNN = """
    WITH v AS (SELECT vec_id, device_name, embedding::DOUBLE[] AS e FROM {chunk_vectors}),
    d AS (SELECT q.vec_id AS query_id, i.vec_id AS item_id, i.device_name, q.device_name AS mine,
      round(1 - list_cosine_similarity(q.e, i.e), 6) + 0.0 AS distance FROM v q JOIN v i ON i.device_name = q.device_name OR i.device_name = '_GLOBAL_'),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id, device_name ORDER BY distance, item_id) AS place FROM d)
"""


def _queries(t: Tables):
    return t.chunk_vectors.select(F.col("vec_id").alias("query_id"), "device_name", (F.col("vec_id") % 3 != 0).alias("verified"), F.col("embedding").alias("vector"))


def _items(t: Tables):
    return t.chunk_vectors.select(F.col("vec_id").alias("item_id"), "device_name", F.col("embedding").alias("vector"))


@query("s05_nearest_chunks", _KNN + """
    SELECT query_id, item_id, distance, CAST(place AS INTEGER) AS place FROM r WHERE place <= 4 AND device_name = mine""")
def s05(t: Tables):
    q = _queries(t).withColumnRenamed("device_name", "on").select("on", "query_id", "vector")
    return D.nearest(q, _items(t).withColumnRenamed("device_name", "on"), "on", 4)


@query("j17_retrieval", _KNN + """, u AS (SELECT DISTINCT query_id, item_id, distance FROM r WHERE place <= 4 AND (device_name = '_GLOBAL_' OR query_id % 3 <> 0))
    SELECT query_id, item_id, distance, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, item_id) AS INTEGER) AS place FROM u""")
def j17(t: Tables):
    return D.retrieve(_queries(t), _items(t))


@query("o04_branch_union", _KNN + """
    SELECT query_id, count(DISTINCT item_id) AS items FROM r WHERE place <= 4 AND (device_name = '_GLOBAL_' OR query_id % 3 <> 0) GROUP BY query_id""")
def o04(t: Tables):
    return D.retrieve(_queries(t), _items(t)).groupBy("query_id").agg(F.count(F.lit(1)).alias("items"))


@query("f32_context_blocks", """
    WITH r AS (SELECT lang, doc_id, source, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS place FROM {documents})
    SELECT lang, string_agg('[资料' || CAST(place AS VARCHAR) || '] 设备=' || lang || ' | 文件=' || source || ' | 页=' || CAST(n_chars AS VARCHAR) || ' | 章节=s' || chr(10)
      || 'doc ' || CAST(doc_id AS VARCHAR), chr(10) || chr(10) ORDER BY place) AS context FROM r WHERE place <= 8 GROUP BY lang""")
def f32(t: Tables):
    from pilotlamp.operators.ordered import top_in_groups
    top = top_in_groups(t.documents.select("lang", "doc_id", "source", "n_chars"), ["lang"], [("n_chars", "desc"), ("doc_id", "asc")], 8, "place")
    return D.source_blocks(top.select("lang", "place", F.col("lang").alias("device_name"), F.col("source").alias("source_file"),
                                      F.col("n_chars").alias("page"), F.lit("s").alias("section"),
                                      F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("text")), "lang")
