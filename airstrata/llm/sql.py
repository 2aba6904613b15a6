"""DuckDB SQL with the results of the queries that SQL can express."""

# CRC-32 of a list of bytes, bit by bit: 3988292384 is its fixed polynomial.
CRC = """
    tab AS MATERIALIZED (
      SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS entry)"""


def crc(octets: str) -> str:
    return (
        f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), "
        "lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255) + 1])), 4294967295)"
    )


def octets(text: str) -> str:
    return f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"


def leaf(text: str) -> str:
    parts = [
        f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
        for c in ("doc_id", "source", "lang", "n_chars", text)
    ]
    return f"sha256({' || '.join(parts)})"


def merkle() -> str:
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def levels(name: str, start: str) -> str:
        return f"""
    {name} AS (
      {start}
      UNION ALL
      SELECT grp, lev + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
      FROM {name} WHERE n > 1 GROUP BY grp, lev, pos // 8, n)"""

    def steps(name: str, source: str) -> str:
        return f"""
    {name} AS MATERIALIZED (
      SELECT a.grp, a.lev, a.pos,
             coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS early,
             coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS late
      FROM {source} a JOIN {source} b ON a.grp = b.grp AND a.lev = b.lev AND a.pos // 8 = b.pos // 8
      WHERE a.n > 1 GROUP BY a.grp, a.lev, a.pos)"""

    first = "SELECT grp, 0 AS lev, pos, n, leaf AS digest FROM leaves"
    second = """SELECT 0 AS grp, 0 AS lev, row_number() OVER (ORDER BY grp) - 1 AS pos,
             count(*) OVER () AS n, digest FROM low WHERE n = 1"""
    return f"""
    WITH RECURSIVE {CRC},
    marked AS (
      SELECT *, CASE WHEN lang IS NULL THEN '!' ELSE '+' || lang END AS grp,
             coalesce({crc(octets("CAST(doc_id AS VARCHAR)"))} % 3 = 0, FALSE) AS altered
      FROM documents, tab),
    leaves AS MATERIALIZED (
      SELECT grp, doc_id, {leaf("text")} AS leaf,
             {leaf("CASE WHEN altered THEN " + lower + " ELSE text END")} AS claimed,
             row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, {leaf("text")}) - 1 AS pos,
             count(*) OVER (PARTITION BY grp) AS n
      FROM marked),
    {levels("low", first)},
    subs AS (SELECT grp, digest AS subroot, row_number() OVER (ORDER BY grp) - 1 AS place FROM low WHERE n = 1),
    {levels("high", second)},
    {steps("low_steps", "low")},
    {steps("high_steps", "high")},
    powers AS (SELECT k, CAST(pow(8, k) AS BIGINT) AS p FROM range(20) t(k)),
    path AS MATERIALIZED (
      SELECT l.grp, l.pos, s.lev AS k, s.early, s.late FROM leaves l, powers JOIN low_steps s
        ON s.grp = l.grp AND s.lev = k AND s.pos = l.pos // p
      UNION ALL
      SELECT l.grp, l.pos, 100 + s.lev, s.early, s.late FROM leaves l JOIN subs USING (grp), powers JOIN high_steps s
        ON s.lev = k AND s.pos = place // p),
    walk AS (
      SELECT grp, pos, row_number() OVER (PARTITION BY grp, pos ORDER BY k) AS step, early, late FROM path),
    fold AS (
      SELECT grp, pos, CAST(0 AS BIGINT) AS step, claimed AS node FROM leaves
      UNION ALL
      SELECT f.grp, f.pos, w.step, sha256(w.early || f.node || w.late)
      FROM fold f JOIN walk w ON w.grp = f.grp AND w.pos = f.pos AND w.step = f.step + 1),
    ends AS (SELECT grp, pos, arg_max(node, step) AS folded_root FROM fold GROUP BY grp, pos),
    proofs AS (SELECT grp, pos, sha256(string_agg(early || late, '' ORDER BY step)) AS proof FROM walk GROUP BY grp, pos)
    SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root,
           folded_root = root AS verified
    FROM leaves JOIN subs USING (grp) JOIN ends USING (grp, pos) LEFT JOIN proofs USING (grp, pos),
         (SELECT digest AS root FROM high WHERE n = 1)
    """


MERKLE = merkle()


IMPORTANCE = f"""
    WITH {CRC},
    cut AS (
      SELECT *, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
      FROM (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents
            UNION ALL SELECT -row_number() OVER (), NULL, coalesce(text, '') FROM benchmark)),
    features AS MATERIALIZED (
      SELECT k, array_to_string(words[i : i + n - 1], ' ') AS feature, count(*) AS times
      FROM (SELECT k, words, unnest(range(1, len(words) + 1)) AS i FROM cut), (SELECT unnest([1, 2, 3]) AS n)
      WHERE i + n - 1 <= len(words) GROUP BY ALL),
    hashed AS MATERIALIZED (
      SELECT feature, {crc(octets("feature"))} % 10000 AS bucket
      FROM (SELECT DISTINCT feature FROM features), tab),
    found AS MATERIALIZED (SELECT k, bucket, sum(times) AS times FROM features JOIN hashed USING (feature) GROUP BY ALL),
    counts AS (
      SELECT bucket, coalesce(sum(times) FILTER (WHERE k > 0), 0) AS s, coalesce(sum(times) FILTER (WHERE k < 0), 0) AS t
      FROM found GROUP BY bucket),
    totals AS (SELECT coalesce(sum(s), 0) + 10000 AS all_s, coalesce(sum(t), 0) + 10000 AS all_t FROM counts),
    gains AS (
      SELECT bucket, floor(1000 * ln((CAST(t + 1 AS DOUBLE) * CAST(all_s AS DOUBLE))
                                     / (CAST(s + 1 AS DOUBLE) * CAST(all_t AS DOUBLE)))) AS gain
      FROM counts, totals),
    weighed AS (
      SELECT k, CAST(sum(times) AS BIGINT) AS n_features, CAST(sum(times * gain) AS BIGINT) AS weight
      FROM found JOIN gains USING (bucket) WHERE k > 0 GROUP BY k),
    scored AS (
      SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' ||
               coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
      FROM cut LEFT JOIN weighed USING (k) WHERE k > 0),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY n_words >= 20
                                   ORDER BY score DESC, doc_id NULLS LAST, weight, n_features) AS place,
             count(*) FILTER (WHERE n_words >= 20) OVER () AS n FROM scored)
    SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
           CASE WHEN n_words >= 20 AND place <= 5 * n // 100 THEN place END AS rank
    FROM ranked
    """

LINE_RULES = """
    WITH docs AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
    cut AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM docs),
    places AS (SELECT k, words, unnest(range(1, len(words) + 1)) AS i FROM cut),
    windows AS (SELECT k, i, words[i : i + 4] AS part FROM places WHERE i + 4 <= len(words)),
    twice AS (SELECT k, i FROM windows QUALIFY count(*) OVER (PARTITION BY k, part) > 1),
    repeated AS (
      SELECT k, count(DISTINCT j) AS n FROM (SELECT k, unnest(range(i, i + 5)) AS j FROM twice) GROUP BY k),
    split AS (
      SELECT k, unnest(string_split(text, chr(10))) AS line FROM docs),
    lined AS (
      SELECT k, line, len(words) AS n,
             trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS bare,
             len(list_filter(words, lambda w: regexp_matches(w, '[!?#*$%&]{2,}$'))) AS noisy,
             len(list_filter(words, lambda w: regexp_matches(w, '^[|»›•·>/]$'))) AS links
      FROM (SELECT *, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS words FROM split) WHERE len(words) > 0),
    ruled AS (
      SELECT *, CASE
        WHEN NOT regexp_matches(bare, '[.!?…:;。！？]["''”’»)\\]]*$') OR 100 * noisy >= 30 * n THEN 0
        WHEN links >= 2 AND n - links <= 3 * (links + 1) THEN 1
        WHEN n <= 6 AND regexp_matches(bare, '^(?:home|menu|search|login|log in|sign in|sign up|register|next|previous|back to top|read more|skip to content|share this|follow us|subscribe|contact us|click here)(?:[^a-z]|$)') THEN 1
        WHEN regexp_matches(bare, 'all rights reserved|copyright ©|licensed under|released under the|terms of use|terms of service|privacy policy|cookie policy|uses cookies|accept cookies|enable javascript|lorem ipsum|powered by') THEN 2
        END AS rule
      FROM lined),
    lines AS (
      SELECT k, count(*) - count(DISTINCT line) AS n_dup_lines,
             count(*) FILTER (WHERE rule = 0) AS n_punctuation, count(*) FILTER (WHERE rule = 1) AS n_navigation,
             count(*) FILTER (WHERE rule = 2) AS n_boilerplate,
             CAST(coalesce(sum(n) FILTER (WHERE rule IS NOT NULL), 0) AS BIGINT) AS n_words_lost
      FROM ruled GROUP BY k),
    judged AS (
      SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
      FROM (SELECT doc_id, len(words) AS n_words,
                   CAST(coalesce(list_sum(list_transform(words, lambda w: len(w))), 0) AS BIGINT) AS word_chars,
                   len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                   coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
                   coalesce(n_punctuation, 0) AS n_punctuation, coalesce(n_navigation, 0) AS n_navigation,
                   coalesce(n_boilerplate, 0) AS n_boilerplate, coalesce(n_words_lost, 0) AS n_words_lost
            FROM cut LEFT JOIN repeated USING (k) LEFT JOIN lines USING (k)))
    SELECT *, NOT base_failed AND 100 * n_words_lost <= 50 * n_words AS kept FROM judged
    """
