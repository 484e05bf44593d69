"""SQL with the same results as the registered queries, where SQL can express them.

Fingerprints (XXH64), tokenizers, trained models, eigenvectors, list probing and page parsing are beyond SQL; those
queries are tested against brute force.
"""

from __future__ import annotations

from envstream.llm.quality import (
    CLASSES, COMMON_WORDS, MARKS, OTHER, SLOTS, SYMBOLS, Limits,
)

WORD = r"[^\x20\x09-\x0D]+"


def _quality(limits: Limits = Limits()) -> str:
    lists = " ".join(
        f"WHEN '{language}' THEN [{', '.join(repr(word) for word in words)}]"
        for language, words in COMMON_WORDS.items())
    languages = ", ".join(repr(language) for language in COMMON_WORDS)
    marks = MARKS.replace("'", "''")

    def kept_length(pattern: str) -> str:
        return f"length(regexp_replace(text, '{pattern}', '', 'g'))"

    def classed(characters: str) -> str:
        return f"length(text) - length(translate(text, '{characters}', ''))"

    def divergence(p: str, q: str, bins: int) -> str:
        terms = []
        for i in range(1, bins + 1):
            a, b = f"{p}[{i}]", f"{q}[{i}]"
            for x, y in ((a, b), (b, a)):
                terms.append(f"CASE WHEN {x} > 0 THEN {x} * log2(2 * {x} / ({x} + {y})) ELSE 0 END")
        return f"sqrt(greatest(0, ({' + '.join(terms)}) / 2))"

    def shares(counts: str) -> str:
        return f"list_transform({counts}, lambda x: x / greatest(1, list_sum({counts}))::DOUBLE)"

    def allowed(limit: float, bins: int, drawn: str) -> str:
        return f"sqrt({limit ** 2} + {bins - 1} / (8 * ln(2)) / greatest(1, {drawn}))"

    sums = ", ".join(f"sum(classes[{i}])" for i in range(1, len(CLASSES) + 1))
    common = ", ".join(f"sum(common[{i}])" for i in range(1, SLOTS + 1))
    return f"""
    WITH docs AS (
        SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text,
            CASE WHEN lang IN ({languages}) THEN lang ELSE '{OTHER}' END AS profile
        FROM documents),
    cut AS (
        SELECT *, regexp_extract_all(text, '{WORD}') AS words,
            list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS lines,
            coalesce(CASE profile {lists} END, list_transform(range({SLOTS}), lambda i: '')) AS usual
        FROM docs),
    places AS (
        SELECT id, pos, words[pos] || ' ' || words[pos + 1] || ' ' || words[pos + 2] AS triple
        FROM (SELECT id, words, unnest(range(1, len(words) - 1)) AS pos FROM cut)),
    twice AS (
        SELECT id, pos FROM (SELECT id, pos, count(*) OVER (PARTITION BY id, triple) AS n FROM places)
        WHERE n > 1),
    repeated AS (
        SELECT id, count(DISTINCT pos + step) AS n FROM twice, range(3) AS s(step) GROUP BY id),
    counted AS (
        SELECT cut.id, doc_id, profile, len(words) AS n_words,
            {kept_length(r'[\x20\x09-\x0D]+')} AS word_chars,
            {classed(SYMBOLS)} AS n_symbols,
            len(lines) - len(list_distinct(lines)) AS n_dup_lines,
            coalesce(n, 0) AS n_repeat_words, length(text) AS chars,
            [length(text) - {kept_length(r'\p{Ll}+')}, length(text) - {kept_length(r'\p{Lu}+')},
             length(text) - {kept_length(r'\p{Nd}+')},
             length(text) - {kept_length(r'[\x20\x09-\x0D]+')},
             {classed(marks)}, {classed(SYMBOLS)}] AS most,
            list_transform(usual, lambda u: len(list_filter(words, lambda w: lower(w) = u))) AS few
        FROM cut LEFT JOIN repeated ON cut.id = repeated.id),
    judged AS (
        SELECT *, list_append(most, chars - list_sum(most)) AS classes,
            list_append(few, n_words - list_sum(few)) AS common,
            n_words < {limits.min_words}
            OR 100 * n_repeat_words > {limits.max_repeat_percent} * n_words AS base_failed
        FROM counted),
    usual AS (
        SELECT profile, [{sums}] AS ref_classes, [{common}, sum(common[{SLOTS + 1}])] AS ref_common
        FROM judged WHERE NOT base_failed GROUP BY profile),
    shared AS (
        SELECT judged.*, {shares('classes')} AS p, {shares('ref_classes')} AS q,
            {shares('common')} AS pw, {shares('ref_common')} AS qw
        FROM judged LEFT JOIN usual ON judged.profile = usual.profile),
    measured AS (
        SELECT *, {divergence('p', 'q', len(CLASSES))} AS class_distance,
            {divergence('pw', 'qw', SLOTS + 1)} AS word_distance FROM shared)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed
        AND NOT coalesce(chars >= {limits.min_class_chars} AND class_distance
            > {allowed(limits.class_distance, len(CLASSES), 'chars')}, false)
        AND NOT coalesce(profile <> '{OTHER}' AND n_words >= {limits.min_common_words}
            AND word_distance > {allowed(limits.word_distance, SLOTS + 1, 'n_words')}, false) AS kept
    FROM measured"""


def _shards(shards: int = 8, seed: int = 42) -> str:
    """CRC-32 bit by bit: eight steps per entry of the table, one entry per byte of the text."""
    return f"""
    WITH steps AS (
        SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
            lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS entry),
    docs AS (
        SELECT doc_id, coalesce(source, '') AS source, source IS NULL AS no_source,
            encode(coalesce(text, '')) AS bytes,
            md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')) AS shuffle FROM documents),
    crc AS (
        SELECT docs.*, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
            list_transform(range(octet_length(bytes)),
                lambda i: ('0x' || substr(hex(bytes), 2 * i + 1, 2))::BIGINT)),
            lambda c, b: xor(c >> 8, entry[xor(c, b) % 256 + 1]))) AS text_crc32
        FROM docs, steps),
    ranked AS (
        SELECT *, octet_length(bytes) + 1 AS size, row_number() OVER (
            PARTITION BY no_source, source ORDER BY shuffle, doc_id, text_crc32, bytes) AS place,
            count(*) OVER (PARTITION BY no_source, source) AS n, count(*) OVER () AS total FROM crc),
    placed AS (
        SELECT *, row_number() OVER (ORDER BY (place - 0.5::DOUBLE) / n, no_source DESC, source, shuffle,
            doc_id, text_crc32) - 1 AS position FROM ranked)
    SELECT doc_id, size, text_crc32, 'rows' AS law, (position * {shards} // total)::INT AS shard,
        position - (position * {shards} // total * total + {shards - 1}) // {shards} AS slot,
        NULL::INT AS grown_shard FROM placed"""


def _passages(window: int = 35) -> str:
    return f"""
    WITH docs AS (
        SELECT row_number() OVER () AS id, doc_id,
            regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
    starts AS (
        SELECT id, pos, md5(array_to_string(words[pos:pos + {window - 1}], ' ')) AS content
        FROM (SELECT id, words, unnest(range(1, len(words) - {window - 2})) AS pos FROM docs)),
    twice AS (
        SELECT id, pos FROM (SELECT id, pos, count(*) OVER (PARTITION BY content) AS n FROM starts)
        WHERE n > 1),
    gone AS (SELECT DISTINCT id, pos + step AS pos FROM twice, range({window}) AS s(step)),
    single AS (SELECT id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM docs),
    left_over AS (
        SELECT id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n
        FROM single ANTI JOIN gone USING (id, pos) GROUP BY id)
    SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
        sha256(coalesce(kept, '')) AS kept_sha256
    FROM docs LEFT JOIN left_over USING (id)"""


def _ranked(k: int = 50) -> str:
    def terms(table: str) -> str:
        lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return (f"SELECT row_number() OVER () AS row, *, regexp_extract_all({lower}, "
                f"'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM {table}")

    return f"""
    WITH docs AS ({terms('documents')}),
    items AS (SELECT row AS item, item_id, unnest(list_distinct(terms)) AS term FROM ({terms('benchmark')})),
    corpus AS (SELECT count(*) FILTER (len(terms) > 0) AS many, sum(len(terms))::BIGINT AS occurrences FROM docs),
    held AS (
        SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs)
        WHERE term IN (SELECT term FROM items) GROUP BY ALL),
    weighed AS (
        SELECT term, floor(1000 * ln((2 * any_value(many) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
        FROM held, corpus GROUP BY term),
    scored AS (
        SELECT item, item_id, doc_id, row, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (
            100 - 50 + ((50 * len(terms) * many) // occurrences)))))::BIGINT AS score
        FROM items JOIN held USING (term) JOIN weighed USING (term) JOIN docs USING (row), corpus
        GROUP BY ALL)
    SELECT item_id, rank::INT AS rank, doc_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank
        FROM scored WHERE score > 0) WHERE rank <= {k}"""


ORACLES: dict[str, str] = {
    "op1_quality_rules": _quality(),
    "op4_interleaved_shards": _shards(),
    "op7_block_factors": _passages(),
    "op13_hybrid_lists": _ranked(),
}
