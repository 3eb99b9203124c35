"""DuckDB SQL for the operators that SQL can express."""

ORACLES: dict[str, str] = {}

LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES["op6_line_dedup"] = f"""
    WITH lines AS (
        SELECT doc_id, line, pos, translate(trim(line, {WHITE}), {LOWER}) AS key
        FROM (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents
        )
    ),
    shared AS (
        SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
    ),
    marked AS (SELECT lines.*, shared.key IS NOT NULL AS gone FROM lines LEFT JOIN shared USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
"""

ORACLES["op8_decontamination"] = rf"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(translate(text, {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents
    ),
    b AS (
        SELECT item_id, regexp_extract_all(translate(text, {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM benchmark
    ),
    item_windows AS (
        SELECT DISTINCT item_id, least(len(words), 10) AS k, words[pos:pos + least(len(words), 10) - 1] AS w
        FROM (
            SELECT item_id, words, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS pos
            FROM b WHERE len(words) > 0
        )
    ),
    doc_windows AS (
        SELECT doc_id, pos, k, words[pos:pos + k - 1] AS w
        FROM (
            SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS pos
            FROM d, (SELECT DISTINCT k FROM item_windows) WHERE len(words) >= k
        )
    ),
    found AS (SELECT doc_id, pos, k, item_id FROM doc_windows JOIN item_windows USING (k, w)),
    hit AS (
        SELECT doc_id, count(*) AS n_hit
        FROM (SELECT DISTINCT doc_id, unnest(range(pos, pos + k)) AS word FROM found) GROUP BY doc_id
    ),
    named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
    )
    SELECT doc_id, coalesce(len(words), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLES["op10_ngram_jaccard"] = rf"""
    WITH RECURSIVE d AS (
        SELECT doc_id, regexp_extract_all(translate(text, {LOWER}), '[^\x20\x09-\x0D]+') AS w FROM documents
    ),
    sets AS (
        SELECT DISTINCT doc_id, w[pos:pos + least(len(w), 5) - 1] AS gram
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS pos FROM d WHERE len(w) > 0)
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    hashed AS (SELECT doc_id, md5(list_aggregate(gram, 'string_agg', ' ')) AS gram FROM sets),
    common AS (
        SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n
        FROM hashed a JOIN hashed b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL
    ),
    pairs AS (
        SELECT u, v FROM common JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v
        WHERE 100 * common.n >= 75 * (a.n + b.n - common.n)
    ),
    links AS (SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs),
    reached AS (
        SELECT doc_id AS node, doc_id AS root FROM documents
        UNION
        SELECT links.v AS node, reached.root FROM reached JOIN links ON links.u = reached.node WHERE reached.root < links.v
    )
    SELECT d.doc_id, coalesce(max(sizes.n), 0) AS n_shingles, min(reached.root) AS component_id
    FROM d LEFT JOIN sizes USING (doc_id) JOIN reached ON reached.node = d.doc_id GROUP BY d.doc_id
"""


def _escaped_length(text: str) -> str:
    return f"length(replace(replace(replace(replace({text}, '\\', 'xx'), '#', 'xx'), ':', 'xx'), '<', 'xx'))"


ORACLES["op2_chat_formatting"] = rf"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
    ),
    loss AS (
        SELECT conv_id, coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS said,
               count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(sum({_escaped_length("role")} + {_escaped_length("text")} + 14) AS BIGINT) AS formatted_chars
        FROM turns GROUP BY conv_id
    )
    SELECT conv_id, n_turns, turns_sha256, length(said) AS loss_chars, sha256(said) AS loss_sha256, formatted_chars
    FROM loss
"""

_TREE = """
    SELECT doc_id, which, string_agg(hash || sep, '' ORDER BY p) AS hashes, string_agg(leaves || sep, '' ORDER BY p) AS nodes
    FROM (
        SELECT doc_id, which, p, leaves, md5(leaves) AS hash,
               CASE WHEN substr(md5(leaves), 1, 1) IN ('0', '1', '2', '3') THEN ';' ELSE ',' END AS sep
        FROM (
            SELECT doc_id, which, p,
                   coalesce(string_agg(substr(md5(leaf), 1, 8), '.' ORDER BY l) FILTER (WHERE leaf <> ''), '') AS leaves
            FROM (
                SELECT doc_id, which, p, l, substr(par, l + 1, CASE WHEN l < 16 THEN 8 WHEN l < 32 THEN 16 ELSE 32 END) AS leaf
                FROM (
                    SELECT *, unnest(list_concat([0, 8, 16], range(32, greatest(32, length(par)), 32))) AS l
                    FROM (
                        SELECT doc_id, which, unnest(string_split(text, chr(10))) AS par,
                               generate_subscripts(string_split(text, chr(10)), 1) AS p
                        FROM versions
                    )
                )
            ) GROUP BY ALL
        )
    ) GROUP BY ALL
"""

ORACLES["op9_merkle_fingerprints"] = f"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text,
               coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id), first(coalesce(text, '')) OVER (ORDER BY doc_id)) AS next_text,
               coalesce(lead(doc_id) OVER (ORDER BY doc_id), first(doc_id) OVER (ORDER BY doc_id)) AS next_id
        FROM documents
    ),
    edited AS (
        SELECT doc_id, substr(text, 1, length(text) - length(text) // 4) || substr(next_text, 1, length(text) // 4) AS text FROM d
    ),
    versions AS (SELECT doc_id, 'text' AS which, text FROM d UNION ALL SELECT doc_id, 'edited' AS which, text FROM edited),
    trees AS ({_TREE}),
    prints AS (
        SELECT doc_id, which,
               md5(array_to_string(list_transform(string_split(substr(hashes, 1, length(hashes) - 1), ';'), lambda s: md5(s)), ';'))
                   || ':' || substr(nodes, 1, length(nodes) - 1) AS print
        FROM trees
    ),
    sets AS (
        SELECT doc_id, which, print, substr(print, 1, 32) AS root,
               list_distinct(list_filter(regexp_split_to_array(substr(print, 34), '[.,;]'), lambda x: x <> '')) AS leaves
        FROM prints
    ),
    compared AS (
        SELECT d.doc_id, length(d.text) AS n_chars, a.print AS fingerprint, e.print AS edited_fingerprint,
               a.root = e.root AS same_edited, a.root = n.root AS same_next,
               len(list_intersect(a.leaves, e.leaves)) AS common_edited, len(list_intersect(a.leaves, n.leaves)) AS common_next,
               len(a.leaves) AS own, len(e.leaves) AS in_edited, len(n.leaves) AS in_next
        FROM d JOIN sets a ON a.doc_id = d.doc_id AND a.which = 'text'
        JOIN sets e ON e.doc_id = d.doc_id AND e.which = 'edited'
        JOIN sets n ON n.doc_id = d.next_id AND n.which = 'text'
    )
    SELECT compared.doc_id, n_chars, sha256(edited.text) AS edited_sha256, fingerprint, edited_fingerprint,
           CASE WHEN same_edited THEN 1.0::DOUBLE WHEN own + in_edited = 0 THEN 0.0::DOUBLE
                ELSE common_edited::DOUBLE / (own + in_edited - common_edited) END AS near_edited,
           CASE WHEN same_next THEN 1.0::DOUBLE WHEN own + in_next = 0 THEN 0.0::DOUBLE
                ELSE common_next::DOUBLE / (own + in_next - common_next) END AS near_next
    FROM compared JOIN edited USING (doc_id)
"""

ORACLES["op11_source_divergence"] = rf"""
    WITH d AS (
        SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents
    ),
    words AS (SELECT id, lang, source, unnest(terms) AS term FROM d),
    kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
    counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    groups AS (
        SELECT lang, source, coalesce(words, 0) AS words, coalesce(v, 0) AS v, coalesce(lang_words, 0) AS lang_words
        FROM (SELECT DISTINCT lang, source FROM d)
        LEFT JOIN (SELECT lang, source, sum(n) AS words FROM counts GROUP BY ALL) USING (lang, source)
        LEFT JOIN (SELECT lang, count(*) AS v FROM kept GROUP BY lang) USING (lang)
        LEFT JOIN (SELECT lang, sum(n) AS lang_words FROM counts GROUP BY lang) USING (lang)
    ),
    shares AS (
        SELECT lang, source, term, coalesce(n, 0) AS n,
               1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (words + 2 * v)::HUGEINT AS p,
               1 + (1000000000::HUGEINT * (sum(coalesce(n, 0)) OVER (PARTITION BY lang, term) + 2)) // (lang_words + 2 * v)::HUGEINT AS q
        FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
    ),
    pairs AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ),
    every AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
    )
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
           CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
    FROM every QUALIFY part = 'pair' OR rank <= 10
"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes, bit by bit."""
    pairs = f"regexp_extract_all(hex(encode({text})), '..')"
    bits = f"flatten(list_transform({pairs}, lambda c: [CAST('0x' || c AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    step = "CASE WHEN xor(a, e) & 1 = 1 THEN xor(xor(a, e) >> 1, 3988292384) ELSE xor(a, e) >> 1 END"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), lambda a, e: {step}), 4294967295)"


def _leaf(text: str) -> str:
    fields = [f"CAST({name} AS VARCHAR)" for name in ("doc_id", "source", "lang", "n_chars")] + [text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


ORACLES["op13_merkle_manifest"] = f"""
    WITH RECURSIVE d AS (
        SELECT doc_id, coalesce('s' || source, '') AS part, {_leaf("text")} AS leaf,
               CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {_leaf(f"translate(text, {LOWER})")} ELSE {_leaf("text")} END AS copy
        FROM documents
    ),
    leaves AS (
        SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY part) AS n
        FROM d
    ),
    low AS (
        SELECT part, 0 AS level, pos, n, leaf AS digest FROM leaves
        UNION ALL
        SELECT part, any_value(level) + 1, pos // 16, any_value(n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
        FROM low WHERE n > 1 GROUP BY part, pos // 16
    ),
    subroots AS (
        SELECT part, digest, row_number() OVER (ORDER BY encode(part)) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1
    ),
    high AS (
        SELECT 0 AS level, pos, n, digest FROM subroots
        UNION ALL
        SELECT any_value(level) + 1, pos // 16, any_value(n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
        FROM high WHERE n > 1 GROUP BY pos // 16
    ),
    paths AS (
        SELECT doc_id, leaves.part, leaves.copy, low.level, low.pos,
               coalesce((SELECT string_agg(s.digest, '' ORDER BY s.pos) FROM low s
                         WHERE s.part = low.part AND s.level = low.level AND s.pos // 16 = low.pos // 16 AND s.pos < low.pos), '') AS l,
               coalesce((SELECT string_agg(s.digest, '' ORDER BY s.pos) FROM low s
                         WHERE s.part = low.part AND s.level = low.level AND s.pos // 16 = low.pos // 16 AND s.pos > low.pos), '') AS r
        FROM leaves JOIN low ON low.part = leaves.part AND low.n > 1 AND low.pos = leaves.pos // CAST(pow(16, low.level) AS BIGINT)
        UNION ALL
        SELECT doc_id, leaves.part, leaves.copy, 100 + high.level, high.pos,
               coalesce((SELECT string_agg(s.digest, '' ORDER BY s.pos) FROM high s
                         WHERE s.level = high.level AND s.pos // 16 = high.pos // 16 AND s.pos < high.pos), ''),
               coalesce((SELECT string_agg(s.digest, '' ORDER BY s.pos) FROM high s
                         WHERE s.level = high.level AND s.pos // 16 = high.pos // 16 AND s.pos > high.pos), '')
        FROM leaves JOIN subroots ON subroots.part = leaves.part
        JOIN high ON high.n > 1 AND high.pos = subroots.pos // CAST(pow(16, high.level) AS BIGINT)
    ),
    steps AS (SELECT doc_id, part, row_number() OVER (PARTITION BY doc_id, part ORDER BY level) AS step, l, r FROM paths),
    folded AS (
        SELECT doc_id, part, 0 AS step, copy AS digest FROM leaves
        UNION ALL
        SELECT folded.doc_id, folded.part, folded.step + 1, sha256(l || digest || r)
        FROM folded JOIN steps ON steps.doc_id = folded.doc_id AND steps.part = folded.part AND steps.step = folded.step + 1
    ),
    ended AS (SELECT doc_id, part, arg_max(digest, step) AS folded_root FROM folded GROUP BY ALL),
    proofs AS (SELECT doc_id, part, string_agg(l || r, '' ORDER BY step) AS proof FROM steps GROUP BY ALL)
    SELECT leaves.doc_id, leaf, subroots.digest AS subroot, high.digest AS root, sha256(coalesce(proof, '')) AS proof_sha256,
           folded_root, folded_root = high.digest AS verified
    FROM leaves JOIN subroots USING (part) JOIN high ON high.n = 1 JOIN ended USING (doc_id, part) LEFT JOIN proofs USING (doc_id, part)
"""

ORACLES["op12_histogram_sharding"] = f"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 16 AS size,
               md5(coalesce(text, '')) || md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(md5(text), 'null')) AS key
        FROM documents
    ),
    o AS (
        SELECT *, sum(size) OVER (ORDER BY key) AS above, sum(size) OVER (ORDER BY key) - size AS below, sum(size) OVER () AS total,
               count(*) OVER () AS n_all
        FROM d
    ),
    cuts AS (SELECT k, key FROM range(1, 40) t(k) JOIN o ON below * 40 <= total * k AND total * k < above * 40),
    edges AS (
        SELECT k, digits, min(below) AS down, max(above) AS up, any_value(total) AS total
        FROM cuts, (SELECT least(n, 80) AS digits FROM range(3, 82, 2) t(n)) JOIN o ON substr(o.key, 1, digits) = substr(cuts.key, 1, digits)
        GROUP BY k, digits
    ),
    chosen AS (
        SELECT k, arg_min(CASE WHEN total * k - down * 40 <= up * 40 - total * k THEN down ELSE up END, digits) AS edge
        FROM edges WHERE least(total * k - down * 40, up * 40 - total * k) <= 0.005 * total OR digits = 80 GROUP BY k
    ),
    dealt AS (SELECT *, (SELECT count(*) FROM chosen WHERE edge <= below) AS shard FROM o),
    shards AS (
        SELECT shard, greatest(1, ceil(goal * n / n_all), ceil(goal * bytes / total))::BIGINT AS pieces
        FROM (
            SELECT shard, count(*) AS n, sum(size) AS bytes, any_value(n_all) AS n_all, any_value(total) AS total,
                   greatest(32 * 40, ceil(any_value(total) / 268435456)) AS goal
            FROM dealt GROUP BY shard
        )
    ),
    placed AS (
        SELECT doc_id, text, size, shard, key, CAST('0x' || substr(key, 33, 8) AS BIGINT) % pieces AS piece FROM dealt JOIN shards USING (shard)
    )
    SELECT doc_id, size, {_crc32("text")} AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
           row_number() OVER (PARTITION BY shard ORDER BY piece, key) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
    FROM placed
"""
