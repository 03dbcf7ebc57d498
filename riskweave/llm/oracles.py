"""DuckDB statements for those queries of this package that SQL can express at a bearable cost."""

#: The 256 steps of crc32 as a list, and the unsigned crc32 of the UTF-8 bytes of a text, one step a byte.
_CRC_STEPS = "crc AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda v, k: xor(v >> 1, 3988292384 * (v & 1))) ORDER BY i) AS steps FROM range(256) t(i))"


def _crc(text: str) -> str:
    codes = f"list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda v, b: xor(v >> 8, steps[(xor(v, b) & 255) + 1])), 4294967295)"


def _field(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR) || ':' || {column}::VARCHAR END"


def _level(source: str, target: str, tree: str) -> str:
    """CTEs: nodes of ``source`` (tree, r, m, h) with the digests beside them in their run of eight, and their parents."""
    run = f"PARTITION BY {tree}, r // 8 ORDER BY r ROWS BETWEEN"
    return f"""{source}_step AS MATERIALIZED (
            SELECT {tree}, r, CASE WHEN m > 1 THEN coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS lefts,
                   CASE WHEN m > 1 THEN coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS rights FROM {source}),
        {target} AS MATERIALIZED (
            SELECT {tree}, r // 8 AS r, (max(m) + 7) // 8 AS m, CASE WHEN max(m) > 1 THEN sha256(string_agg(h, '' ORDER BY r)) ELSE max(h) END AS h
            FROM {source} GROUP BY {tree}, r // 8)"""


def _merkle(levels: int, over: int) -> str:
    """``levels`` of documents, as many as 8 to that power in a language, and ``over`` levels of languages."""
    ctes = [_level(f"d{k}", f"d{k + 1}", "lang") for k in range(levels)]
    tops = [_level(f"t{k}", f"t{k + 1}", "one") for k in range(over)]
    steps = [("lang", f"d{k}_step", "lang IS NOT DISTINCT FROM f.lang", f"f.r // {8**k}") for k in range(levels)]
    steps += [("one", f"t{k}_step", "true", f"f.t // {8**k}") for k in range(over)]
    folds = []
    for k, (_, step, same, place) in enumerate(steps):
        folds.append(f"""f{k + 1} AS (
            SELECT f.* REPLACE (CASE WHEN lefts IS NULL THEN folded ELSE sha256(lefts || folded || rights) END AS folded, listed || coalesce(lefts || rights, '') AS listed)
            FROM f{k} f JOIN {step} s ON s.{same} AND s.r = {place})""".replace("s.true", "true"))
    return f"""
        WITH {_CRC_STEPS},
        leaves AS (SELECT doc_id, lang, sha256({" || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS h,
            CASE WHEN {_crc("doc_id::VARCHAR")} % 3 = 0 THEN sha256({" || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))} || {_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS bad
            FROM documents, crc),
        d0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS r, count(*) OVER (PARTITION BY lang) AS m FROM leaves),
        {", ".join(ctes)},
        t0 AS MATERIALIZED (SELECT 1 AS one, lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r, count(*) OVER () AS m FROM d{levels}),
        {", ".join(tops)},
        f0 AS (SELECT d0.doc_id, d0.lang, d0.r, t0.r AS t, d0.h AS leaf, t0.h AS subroot, t{over}.h AS root, coalesce(bad, d0.h) AS folded, '' AS listed
            FROM d0 JOIN t0 ON d0.lang IS NOT DISTINCT FROM t0.lang, t{over}),
        {", ".join(folds)}
        SELECT doc_id, leaf, subroot, root, sha256(listed) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM f{len(folds)}"""


ORACLES: dict[str, str] = {
    "op1_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        g AS (SELECT html, max(page_id) AS last FROM p GROUP BY html),
        h AS (SELECT page_id, last, strlen(html) AS payload_bytes, sha1(html) || '0' AS hex FROM p JOIN g USING (html))
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   ((('0x' || substr(hex, (5 * i) // 4 + 1, 2))::INT >> (3 - (5 * i) % 4)) & 31) + 1, 1)), '') AS payload_digest,
               CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> last THEN last END AS refers_to
        FROM h""",
    "op2_decontamination": r"""
        WITH item_words AS (
            SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F\x{80}-\x{BF}\x{2000}-\x{206F}\x{3000}]+'), lambda w: w <> '') AS w FROM benchmark),
        item AS (SELECT item_id, w, least(5, len(w)) AS k FROM item_words WHERE len(w) > 0),
        item_shingle AS (SELECT DISTINCT item_id, k, s FROM (
            SELECT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s FROM item)),
        doc AS (
            SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F\x{80}-\x{BF}\x{2000}-\x{206F}\x{3000}]+'), lambda w: w <> '') AS w FROM documents),
        doc_shingle AS (SELECT DISTINCT doc_id, k, s FROM (
            SELECT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
            FROM doc, (SELECT DISTINCT k FROM item))),
        size AS (SELECT item_id, count(*) AS n_shingles FROM item_shingle GROUP BY item_id),
        shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM item_shingle JOIN doc_shingle USING (k, s) GROUP BY doc_id, item_id)
        SELECT doc_id, item_id, n_shingles, n_shared, n_shared::DOUBLE / n_shingles AS containment
        FROM shared JOIN size USING (item_id) WHERE n_shared >= ceil(0.8 * n_shingles - 1e-9)""",
    "op6_substring_dedup": r"""
        WITH doc AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x09-\x0D\x20]+'), lambda w: w <> '') AS w FROM documents),
        win AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS p, unnest(list_transform(range(1, len(w) - 18), lambda i: array_to_string(w[i:i + 19], ' '))) AS s FROM doc WHERE len(w) >= 20),
        ranked AS (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1 AS again FROM win),
        words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM doc WHERE len(w) > 0),
        judged AS (
            SELECT words.doc_id, words.p, word,
                   coalesce(bool_or(again) OVER (PARTITION BY words.doc_id ORDER BY words.p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone
            FROM words LEFT JOIN ranked ON words.doc_id = ranked.doc_id AND words.p = ranked.p),
        cut AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS kept FROM judged GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM doc LEFT JOIN cut USING (doc_id)""",
    "op10_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, pos, line, regexp_replace(regexp_replace(line, '^[\x09-\x0D\x20]+', ''), '[\x09-\x0D\x20]+$', '') AS bare
            FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents)),
        keys AS (SELECT doc_id, pos, line, translate(bare, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
        shared AS (SELECT k, min(doc_id) AS first FROM keys WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1),
        judged AS (SELECT keys.*, first IS NOT NULL AND first <> doc_id AS gone FROM keys LEFT JOIN shared USING (k))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op11_spelling": rf"""
        WITH RECURSIVE {_CRC_STEPS},
        runs AS (SELECT doc_id, run, count(*) AS n FROM (
            SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
            FROM documents) GROUP BY ALL),
        hashed AS (SELECT run, n, {_crc("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, crc),
        lost AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
        words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM lost WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
        cuts AS MATERIALIZED (SELECT word, n, substr(word, 1, p) AS head, substr(word, p + 2) AS tail FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)),
        near AS (
            SELECT a.word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
            UNION SELECT cuts.word, words.word, words.n FROM cuts JOIN words ON head || tail = words.word
            UNION SELECT words.word, cuts.word, cuts.n FROM cuts JOIN words ON head || tail = words.word),
        ranked AS (SELECT word, other, m, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS r FROM near),
        formed AS MATERIALIZED (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN other END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n
            FROM words LEFT JOIN (SELECT * FROM ranked WHERE r = 1) USING (word)),
        chain AS (
            SELECT word, form AS root FROM formed WHERE form IS NOT NULL
            UNION ALL SELECT chain.word, formed.form FROM chain JOIN formed ON chain.root = formed.word WHERE formed.form IS NOT NULL),
        ends AS (SELECT chain.word, root FROM chain JOIN formed ON root = formed.word WHERE form IS NULL)
        SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM formed LEFT JOIN ends USING (word)""",
    "op12_rules": r"""
        WITH doc AS (
            SELECT doc_id, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x09-\x0D\x20]+'), lambda w: w <> '') AS w,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x09-\x0D\x20]')) AS lines FROM documents),
        word AS (SELECT doc_id, unnest(range(len(w))) AS p, unnest(w) AS x FROM doc),
        win AS (SELECT doc_id, p, x || ' ' || lead(x, 1) OVER a || ' ' || lead(x, 2) OVER a AS s FROM word WINDOW a AS (PARTITION BY doc_id ORDER BY p)),
        twice AS (SELECT doc_id, p, s IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, s) > 1 AS again FROM win),
        held AS (SELECT doc_id, bool_or(again) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS held FROM twice),
        repeats AS (SELECT doc_id, count(*) FILTER (held) AS n_repeat_words FROM held GROUP BY doc_id),
        m AS (
            SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                   coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
                   len(list_filter(w, lambda x: NOT regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]')))::BIGINT AS n_unlettered,
                   len(list_filter(w, lambda x: regexp_matches(x, '^[A-ZÀ-Þ]{2}')))::BIGINT AS n_shouted,
                   len(list_filter(w, lambda x: regexp_matches(x, '[.!?:;,]{2}$')))::BIGINT AS n_marked,
                   coalesce(list_max(list_transform(w, lambda x: strlen(x))), 0)::BIGINT AS longest_bytes
            FROM doc LEFT JOIN repeats USING (doc_id)),
        judged AS (
            SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
                   + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
                   + CASE WHEN word_chars < 3 * n_words OR word_chars > 10 * n_words THEN 16 ELSE 0 END + CASE WHEN 100 * n_unlettered > 20 * n_words THEN 32 ELSE 0 END
                   + CASE WHEN 100 * n_shouted > 30 * n_words THEN 64 ELSE 0 END + CASE WHEN 100 * n_marked > 30 * n_words THEN 128 ELSE 0 END
                   + CASE WHEN longest_bytes > 1000 THEN 256 ELSE 0 END)::BIGINT AS failures FROM m)
        SELECT *, failures & 3 <> 0 AS base_failed, failures = 0 AS kept FROM judged""",
    "op13_merkle": _merkle(7, 3),
}
