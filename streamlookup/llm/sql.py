"""SQL counterparts of the queries that DuckDB can express."""

from __future__ import annotations

from streamlookup.llm import licenses


def quality_rules() -> str:
    return r"""
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        split AS (
            SELECT doc_id, text,
                list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
                list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM texts),
        windows AS (
            SELECT doc_id, unnest(range(1, len(words) - 1)) AS place,
                unnest(list_transform(range(1, len(words) - 1),
                    lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) AS three
            FROM split),
        repeated AS (
            SELECT doc_id, place FROM (
                SELECT doc_id, place, count(*) OVER (PARTITION BY doc_id, three) AS n FROM windows) WHERE n > 1),
        covered AS (
            SELECT doc_id, count(DISTINCT word) AS n
            FROM (SELECT doc_id, unnest([place, place + 1, place + 2]) AS word FROM repeated) GROUP BY doc_id),
        counted AS (
            SELECT doc_id, text, len(words) AS n_words, len(list_distinct(words)) AS n_distinct,
                coalesce(c.n, 0) AS n_repeat_words, len(lines) AS n_lines,
                len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                length(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars,
                length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols
            FROM split LEFT JOIN covered c USING (doc_id)),
        judged AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
        SELECT doc_id, n_words, n_distinct, n_repeat_words, n_lines, n_dup_lines, word_chars, n_symbols, base_failed,
            NOT (base_failed
                OR 10 * n_symbols > 3 * n_words
                OR 2 * n_dup_lines > n_lines
                OR 10 * n_distinct < n_words
                OR word_chars > 20 * n_words OR word_chars < 2 * n_words
                OR 5 * (length(text) - length(translate(text, '!', ''))) > n_words
                OR 2 * (length(text) - length(regexp_replace(text, '\p{Lu}+', '', 'g'))) > word_chars) AS kept
        FROM judged"""


def license_scan() -> str:
    numbers = sorted(licenses.SENTENCES)
    if numbers != list(range(1, len(numbers) + 1)):
        raise ValueError("sentences must be numbered from 1")
    known = ", ".join(f"'{licenses.normal(licenses.SENTENCES[i])}'" for i in numbers)

    def sequence(ends: str) -> str:
        later = licenses.OR_LATER.format(r"\1")
        plus = rf"regexp_replace(lower(s), '{licenses.PLUS}', '{later}', 'g')"
        normal = rf"trim(regexp_replace({plus}, '{licenses.NOT_WORD}', ' ', 'g'))"
        places = f"list_transform(regexp_split_to_array(text, '{ends}'), lambda s: list_position([{known}], {normal}))"
        found = f"list_filter({places}, lambda i: i > 0)"
        return f"array_to_string(list_transform({found}, lambda i: ',' || i || ','), '')"

    def first(column: str) -> str:
        cases = (
            f"WHEN regexp_matches({column}, '{'.*'.join(f',{i},' for i in rule.sentences)}') THEN {at}"
            for at, rule in enumerate(licenses.RULES)
        )
        return f"CASE {' '.join(cases)} END"

    def named(name: str, any_of: str, larger: str | None) -> str:
        apart = f" AND NOT regexp_matches(found, '{larger}')" if larger else ""
        return f"CASE WHEN regexp_matches(found, '{any_of}'){apart} THEN '{name}' END"

    every = ", ".join(named(*p) for p in licenses.all_patterns())
    names = ", ".join(f"'{rule.license}'" for rule in licenses.RULES)
    free = ", ".join(str(rule.permissive).lower() for rule in licenses.RULES)
    return rf"""
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        read AS (
            SELECT doc_id, {sequence(licenses.BY_LINE)} AS by_line, {sequence(licenses.BY_PARAGRAPH)} AS by_paragraph
            FROM texts),
        ruled AS (SELECT *, {first("by_line")} AS at_line, {first("by_paragraph")} AS at_paragraph FROM read),
        chosen AS (
            SELECT doc_id, least(at_line, at_paragraph) AS rule,
                CASE WHEN at_paragraph IS NOT NULL AND (at_line IS NULL OR at_paragraph < at_line)
                    THEN by_paragraph ELSE by_line END AS found
            FROM ruled)
        SELECT doc_id, [{names}][rule + 1] AS license, [{free}][rule + 1] AS permissive,
            CASE WHEN rule IS NOT NULL THEN array_to_string(list_filter([{every}], lambda n: n IS NOT NULL), ' ') END AS licenses,
            trim(regexp_replace(found, ',+', ' ', 'g')) AS sentences
        FROM chosen"""


def source_divergence() -> str:
    return r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents),
        terms AS (
            SELECT row, lang, source,
                unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM docs),
        kept AS (
            SELECT lang, term, count(*)::HUGEINT AS n FROM terms GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
        langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
        groups AS (SELECT DISTINCT lang, source FROM docs),
        counts AS (
            SELECT lang, source, term, count(*)::HUGEINT AS n
            FROM terms JOIN kept USING (lang, term) GROUP BY lang, source, term),
        sums AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM counts GROUP BY lang, source),
        grid AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                1 + 1000000000 * (coalesce(c.n, 0) + 2) // (coalesce(s.n, 0) + 2 * l.v) AS p,
                1 + 1000000000 * (k.n + 2) // (l.n + 2 * l.v) AS q
            FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
                LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
                LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
            FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY a.lang, a.source, b.source),
        parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
                LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM grid WHERE n > 0 AND p > q),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
        FROM ranked WHERE part = 'pair' OR rank <= 10"""


def sharding() -> str:
    # CRC-32 byte by byte: its table from the polynomial, the bytes of a text from its characters.
    return r"""
        WITH crc AS (
            SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
                lambda a, b: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END)) AS t),
        points AS (
            SELECT doc_id, coalesce(source, '') AS stratum,
                CASE WHEN coalesce(text, '') = '' THEN []
                    ELSE list_transform(string_split(text, ''), lambda c: ord(c)) END AS points
            FROM documents),
        bytes AS (
            SELECT doc_id, stratum, flatten(list_transform(points, lambda p: CASE
                WHEN p < 128 THEN [p]
                WHEN p < 2048 THEN [192 + (p >> 6), 128 + (p & 63)]
                WHEN p < 65536 THEN [224 + (p >> 12), 128 + ((p >> 6) & 63), 128 + (p & 63)]
                ELSE [240 + (p >> 18), 128 + ((p >> 12) & 63), 128 + ((p >> 6) & 63), 128 + (p & 63)] END)) AS bytes
            FROM points),
        sized AS (
            SELECT doc_id, stratum, len(bytes) + 1 AS size,
                xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], bytes::BIGINT[]),
                    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS text_crc32
            FROM bytes, crc),
        ranked AS (
            SELECT *, count(*) OVER (PARTITION BY stratum) AS total,
                row_number() OVER (
                    PARTITION BY stratum
                    ORDER BY md5('shards:' || coalesce(doc_id::VARCHAR, '') || ':' || size || ':' || text_crc32),
                        doc_id NULLS FIRST, size, text_crc32) - 1 AS rank
            FROM sized),
        placed AS (
            SELECT *, row_number() OVER (ORDER BY (rank + 0.5::DOUBLE) / total::DOUBLE, stratum, rank) - 1 AS place,
                count(*) OVER () AS n
            FROM ranked)
        SELECT doc_id, size, text_crc32, 'rows' AS law, (place * 16 // n)::INT AS shard,
            place - ((place * 16 // n) * n + 15) // 16 AS slot, NULL::INT AS grown_shard
        FROM placed"""


ORACLE_SQL = {
    "op4_license_scan": license_scan(),
    "op10_quality_rules": quality_rules(),
    "op11_source_divergence": source_divergence(),
    "op12_sharding": sharding(),
}
