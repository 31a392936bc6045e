"""DuckDB SQL of the queries that SQL can express."""

#: CRC-32 of ASCII or UTF-8 text: a table by the polynomial's rule, then a fold over the bytes.
CRC32 = """
        t256 AS (SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k:
                     CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
"""


def crc32(bytes_list: str, table: str = "tab") -> str:
    """SQL of the CRC-32 of a list of bytes as BIGINT."""
    return (f"xor(list_reduce(list_concat([4294967295], {bytes_list}), "
            f"lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])), 4294967295)")


def utf8(text: str) -> str:
    """SQL of the list of a text's UTF-8 bytes as BIGINT."""
    return (f"list_transform(range(octet_length(encode({text}))), "
            f"lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)")


ORACLE = {
    "op4_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
        f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM d LEFT JOIN f USING (payload_digest)""",
    "op8_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
                   WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op10_substring": """
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
        s AS (SELECT doc_id, unnest(range(len(words) - 49)) AS i, words FROM w WHERE len(words) >= 50),
        h AS (SELECT doc_id, i, md5(array_to_string(words[i + 1:i + 50], ' ')) AS h FROM s),
        f AS (SELECT h, min(doc_id) AS first FROM h GROUP BY h),
        g AS (SELECT DISTINCT doc_id, i + unnest(range(50)) AS place FROM h JOIN f USING (h) WHERE first < doc_id),
        l AS (SELECT doc_id, list(place) AS gone FROM g GROUP BY doc_id),
        k AS (SELECT w.doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
                     CASE WHEN gone IS NULL THEN words ELSE list_filter(words, lambda x, i: NOT list_contains(gone, i - 1))
                     END AS kept
              FROM w LEFT JOIN l USING (doc_id))
        SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k""",
    "op11_line_quality": """
        WITH d AS (SELECT doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS text,
                          regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
        l AS (SELECT doc_id, host, text, line, row_number() OVER (PARTITION BY doc_id, line) AS nth,
                     regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS words
              FROM (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM d)),
        n AS (SELECT *, translate(array_to_string(words, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz') AS line_key FROM l WHERE len(words) > 0),
        c AS (SELECT host, line_key FROM n JOIN (SELECT host, count(DISTINCT text) AS docs FROM d GROUP BY 1) USING (host)
              GROUP BY 1, 2, docs HAVING count(DISTINCT text) > 20 AND count(DISTINCT text) > 0.01::DOUBLE * docs),
        p AS (SELECT doc_id, count(*) FILTER (nth > 1) AS n_dup_lines,
                     coalesce(sum(len(words)) FILTER ((host, line_key) IN (SELECT (host, line_key) FROM c)), 0) AS gone
              FROM n GROUP BY 1),
        w AS (SELECT doc_id, unnest(range(len(words) - 7)) AS i, words FROM d WHERE len(words) >= 8),
        v AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i + 1:i + 8], ' ')) AS times FROM w),
        r AS (SELECT doc_id, count(DISTINCT place) AS n_repeat_words
              FROM (SELECT doc_id, i + unnest(range(8)) AS place FROM v WHERE times > 1) GROUP BY 1),
        m AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
                     length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                     coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                     coalesce(gone, 0) AS gone
              FROM d LEFT JOIN p USING (doc_id) LEFT JOIN r USING (doc_id)),
        b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
        SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
               n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
               NOT base_failed AND gone <= 0.5 * n_words AS kept FROM b""",
    "op12_importance": f"""
        WITH {CRC32}
        x AS (SELECT 0 AS part, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
        w AS (SELECT part, id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM x),
        f AS (SELECT part, id, row, unnest(list_concat(words, list_transform(range(1, len(words)),
                  lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM w),
        h AS (SELECT feature, {crc32(utf8("feature"))} % 10000 AS bucket FROM (SELECT DISTINCT feature FROM f), t256),
        g AS (SELECT part, id, row, bucket FROM f JOIN h USING (feature)),
        n AS (SELECT bucket, count(*) FILTER (part = 0) AS s, count(*) FILTER (part = 1) AS t FROM g GROUP BY 1),
        a AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM n),
        k AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE
                     / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain FROM n, a),
        e AS (SELECT row, count(*) AS n_features, sum(gain)::BIGINT AS gains FROM g JOIN k USING (bucket)
              WHERE part = 0 GROUP BY 1),
        d AS (SELECT id AS doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features,
                     coalesce(floor(gains::DOUBLE / n_features), 0)::BIGINT AS weight,
                     ('0x' || substr(sha256('7:' || id), 1, 8))::BIGINT AS u
              FROM w LEFT JOIN e USING (row) WHERE part = 0),
        o AS (SELECT *, weight + floor(-1000 * ln(-ln((u + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM d),
        r AS (SELECT doc_id, n_words, n_features, weight, score, CASE WHEN n_words >= 20 THEN row_number() OVER (
                     PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) END AS place,
                     count(*) FILTER (n_words >= 20) OVER () * 25 // 100 AS drawn FROM o)
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM r""",
    "op13_merkle": f"""
        WITH RECURSIVE {CRC32}
        d AS (SELECT doc_id, lang, n_chars, coalesce({crc32(utf8("doc_id::VARCHAR"))} % 7 = 0, false) AS bad,
                     CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
                     || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
                     || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
                     CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail FROM documents, t256),
        e AS (SELECT doc_id, lang, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars
                     END || tail) AS leaf,
                     sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen((n_chars + bad::INT)::VARCHAR) || ':'
                     || (n_chars + bad::INT) END || tail) AS found FROM d),
        p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM e),
        tree AS (SELECT lang, 0 AS level, i, leaf AS digest, count(*) OVER (PARTITION BY lang) AS n FROM p
                 UNION ALL
                 SELECT lang, level + 1, i // 2, sha256(string_agg(digest, '' ORDER BY i)), (n + 1) // 2 FROM tree
                 WHERE n > 1 GROUP BY lang, level, i // 2, n),
        subs AS (SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM tree WHERE n = 1),
        trunk AS (SELECT 0 AS level, i, digest, count(*) OVER () AS n FROM subs
                  UNION ALL
                  SELECT level + 1, i // 2, sha256(string_agg(digest, '' ORDER BY i)), (n + 1) // 2 FROM trunk
                  WHERE n > 1 GROUP BY level, i // 2, n),
        heights AS (SELECT lang, max(level) AS h FROM tree GROUP BY 1),
        steps AS (SELECT p.doc_id, p.leaf, t.level AS step, (p.i >> t.level) & 1 AS right_one, s.digest AS sibling
                  FROM p JOIN tree t ON t.lang IS NOT DISTINCT FROM p.lang AND t.i = p.i >> t.level AND t.n > 1
                  LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = t.level
                                   AND s.i = xor(p.i >> t.level, 1)
                  UNION ALL
                  SELECT p.doc_id, p.leaf, h + t.level, (b.i >> t.level) & 1, s.digest
                  FROM p JOIN heights USING (lang) JOIN subs b USING (lang)
                  JOIN trunk t ON t.i = b.i >> t.level AND t.n > 1
                  LEFT JOIN trunk s ON s.level = t.level AND s.i = xor(b.i >> t.level, 1)),
        proofs AS (SELECT doc_id, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256 FROM steps GROUP BY 1),
        fold AS (SELECT doc_id, 0 AS step, found AS digest FROM p
                 UNION ALL
                 SELECT doc_id, step + 1, sha256(CASE WHEN sibling IS NULL THEN digest WHEN right_one = 1 THEN sibling || digest
                                                      ELSE digest || sibling END)
                 FROM fold JOIN steps USING (doc_id, step)),
        folded AS (SELECT doc_id, arg_max(digest, step) AS folded_root FROM fold GROUP BY 1)
        SELECT doc_id, leaf, subs.digest AS subroot, trunk.digest AS root, proof_sha256, folded_root,
               folded_root = trunk.digest AS verified
        FROM p JOIN subs ON subs.lang IS NOT DISTINCT FROM p.lang JOIN trunk ON trunk.n = 1
        JOIN proofs USING (doc_id) JOIN folded USING (doc_id)""",
}
