"""SQL equivalents for DuckDB, over whole tables.

Operators 3, 4, 8, 9, 10 and 13 and the pipeline need hashes, vocabularies, alignments, distributions or a fitted
model that SQL lacks; ``tests/llm`` holds them against plain versions. The pseudonyms of operator 2 have no SQL either.
"""

from __future__ import annotations

from muara.llm.licenses import PHRASES, TEMPLATES, needed, span

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _windows(units: str, window: str, joined: str, sha: str) -> str:
    """Removal of what a 50-unit window of a smaller document covers; ``units`` gives (doc_id, i, u) from 1."""
    return f"""u as ({units}),
        win as (select doc_id, i, {window} k from u qualify count(*) over
            (partition by doc_id order by i rows between current row and 49 following) = 50),
        own as (select *, min(doc_id) over (partition by k) least from win),
        lost as (select distinct doc_id, i + s.generate_series i from own, generate_series(0, 49) s where least < doc_id),
        kept as (select u.doc_id, count(*) filter (where l.i is null) n, {joined} j
            from u left join lost l on l.doc_id = u.doc_id and l.i = u.i group by 1),
        runs as (select doc_id, count(*) n from (select doc_id, i, lag(i) over (partition by doc_id order by i) p from lost)
            where p is null or i > p + 1 group by 1),
        size as (select doc_id, count(*) n from u group by 1)
        select d.doc_id, coalesce(size.n, 0) total, coalesce(size.n, 0) - coalesce(kept.n, 0) removed,
            coalesce(runs.n, 0) runs, {sha} kept_sha256
        from documents d left join size using (doc_id) left join kept using (doc_id) left join runs using (doc_id)"""


def _suffix_dedup() -> str:
    units = """select doc_id, unnest(range(1, n + 1)) i, substr(h, 2 * unnest(range(1, n + 1)) - 1, 2) u
        from (select doc_id, hex(encode(coalesce(text, ''))) h, octet_length(encode(coalesce(text, ''))) n from documents)"""
    window = "string_agg(u, '') over (partition by doc_id order by i rows between current row and 49 following)"
    joined = "string_agg(u.u, '' order by u.i) filter (where l.i is null)"
    text = _windows(units, window, joined, "sha256(unhex(coalesce(kept.j, '')))")
    return f"with {text}".replace("total,", "n_bytes,").replace(" removed,", " n_removed,").replace(" runs, sha", " n_spans, sha")


def _substring_dedup() -> str:
    units = f"select doc_id, unnest(range(1, len(w) + 1)) i, unnest(w) u from (select doc_id, {WORDS} w from documents)"
    window = "string_agg(u, ' ') over (partition by doc_id order by i rows between current row and 49 following)"
    joined = "string_agg(u.u, ' ' order by u.i) filter (where l.i is null)"
    text = _windows(units, window, joined, "sha256(coalesce(kept.j, ''))")
    return f"select doc_id, total n_words, removed n_removed, kept_sha256 from (with {text})"


def _quality() -> str:
    return rf"""with w as (select doc_id, coalesce(text, '') t, {WORDS} ws from documents),
        m as (select doc_id, t, ws, len(ws) n, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) c,
            length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) s,
            list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) lines,
            len(list_filter(ws, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) letters from w),
        tri as (select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] k
            from (select doc_id, ws, unnest(range(1, len(ws) - 1)) i from w)),
        again as (select doc_id, i from tri qualify count(*) over (partition by doc_id, k) > 1),
        rep as (select doc_id, count(distinct i + s.generate_series) r from again, generate_series(0, 2) s group by 1),
        b as (select m.doc_id, n, c, s, len(lines) - len(list_distinct(lines)) dup, len(lines) nl, letters, coalesce(r, 0) r
            from m left join rep using (doc_id)),
        f as (select *, n < 50 or 100 * r > 50 * n bad from b)
        select doc_id, n n_words, cast(c as bigint) word_chars, s n_symbols, dup n_dup_lines, r n_repeat_words, bad base_failed,
            not bad and not (10 * s > n or 2 * dup > nl or c < 3 * n or c > 12 * n or 5 * letters < 4 * n) kept from f"""


def _licenses() -> str:
    starts = " union all ".join(
        f"select doc_id, i, '{label}' label from p where "
        + " and ".join(f"ws[i + {k}] = '{word}'" for k, word in enumerate(phrase.split()))
        for phrase, label in PHRASES.items()
    )
    shown = lambda words: "[" + ", ".join(f"'{w}'" for w in sorted(set(words))) + "]::varchar[]"
    templates = ", ".join(
        f"({nr}, '{t.label}', {shown(t.text.split())}, {shown(t.must.split())}, {shown(t.without.split())},"
        f" {len(set(t.text.split()))}, {needed(len(set(t.text.split())))}, {span(t.text)})"
        for nr, t in enumerate(TEMPLATES)
    )
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""with w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') ws from documents),
        p as (select doc_id, ws, unnest(range(1, len(ws) + 1)) i from w),
        base as ({starts}),
        t(nr, label, words, must, without, n, need, span) as (values {templates}),
        c as (select doc_id, nr, ws from w, t
            where len(list_intersect(ws, words)) >= need and len(list_intersect(ws, must)) = len(must)),
        x as (select doc_id, nr, unnest(range(1, len(ws) + 1)) i, unnest(ws) u from c),
        s as (select doc_id, nr, i, u, label, words, must, n, need, span, min(case when list_contains(without, u) then i end)
            over (partition by doc_id, nr order by i rows between current row and unbounded following) stop from x join t using (nr)),
        h as (select * from s where list_contains(words, u)),
        runs as (select a.doc_id, any_value(a.label) label, count(distinct b.u) / any_value(a.n)::double share
            from h a join h b on a.doc_id = b.doc_id and a.nr = b.nr and b.i >= a.i and b.i < a.i + a.span and (a.stop is null or b.i < a.stop)
            group by a.doc_id, a.nr, a.i
            having count(distinct b.u) >= any_value(a.need)
                and count(distinct b.u) filter (list_contains(b.must, b.u)) = any_value(len(a.must))),
        l as (select doc_id, label from runs union select doc_id, label from base),
        names as (select doc_id, string_agg(distinct label, ',' order by label) labels from l group by 1),
        bases as (select doc_id, count(*) n, min(i) - 1 a, max(i) - 1 z, string_agg(distinct label, ',' order by label) labels
            from base group by 1),
        best as (select doc_id, max(share) share from runs group by 1)
        select w.doc_id, len(ws) n_words, coalesce(bases.n, 0) n_base, a first_word, z last_word,
            coalesce(bases.labels, '') base_labels, coalesce(names.labels, '') labels,
            case when bases.n > 0 then 1.0::double else coalesce(share, 0.0::double) end score
        from w left join bases using (doc_id) left join names using (doc_id) left join best using (doc_id)"""


def _vector_codes(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    def nearest(name: str, book: str) -> str:
        return f"""{name} as (select vec_id, part, any_value(v) v, min(list_sum(list_transform(list_zip(v, c),
            lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint * {entries} + entry) m from p join {book} using (part) group by 1, 2)"""

    steps = []
    for k in range(rounds):
        steps.append(nearest(f"a{k}", f"c{k}"))
        steps.append(f"""m{k} as (select part, entry, list((s - ((s % n) + n) % n) // n order by i) c from
            (select part, m % {entries} entry, i, sum(v[i])::bigint s, count(*) n from a{k}, lateral unnest(range(1, len(v) + 1)) u(i)
                group by 1, 2, 3) group by 1, 2),
            c{k + 1} as (select part, entry, coalesce(m{k}.c, c{k}.c) c from c{k} left join m{k} using (part, entry))""")
    return f"""with kept as (select vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) e
            from embeddings where embedding is not null
                and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
        p as (select vec_id, part, e[part * (len(e) // {parts}) + 1:(part + 1) * (len(e) // {parts})] v
            from kept, range({parts}) r(part)),
        c0 as (select part, row_number() over (partition by part order by vec_id) - 1 entry, v c from p
            where vec_id in (select vec_id from kept order by vec_id limit {entries})),
        {", ".join(steps)},
        {nearest("z", f"c{rounds}")},
        coded as (select vec_id, string_agg(format('{{:02x}}', m % {entries}), '' order by part) code, sum(m // {entries})::bigint error
            from z group by 1),
        books as (select sha256(string_agg(x, ',' order by part, entry)) h from
            (select part, entry, array_to_string(c, ',') x from c{rounds})),
        sums as (select label, sum(error)::bigint label_error from coded join kept using (vec_id) group by 1)
        select vec_id, code, error, label_error, h codebooks_sha256 from coded join kept using (vec_id)
            join sums on sums.label is not distinct from kept.label, books"""


def _crc_rows() -> list[int]:
    """The byte table of CRC-32, from its polynomial."""
    rows = []
    for x in range(256):
        for _ in range(8):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        rows.append(x)
    return rows


def _resampling(buckets: int = 10_000, percent: int = 10, least: int = 20, seed: int = 2024) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    digit = "strpos('123456789ABCDEF', substr(h, {}, 1))"
    return f"""with d as (select doc_id, {words} ws from documents),
        b as (select {words} ws from benchmark),
        v as (select distinct w from (select unnest(ws) w from d union all select unnest(ws) from b)),
        bytes as (select w, list_transform(range(1, length(h), 2),
            lambda i: {digit.format("i")} * 16 + {digit.format("i + 1")}) l from (select w, hex(encode(w)) h from v)),
        t as (select {_crc_rows()}::bigint[] t),
        crc as (select w, xor(list_reduce(list_prepend(4294967295::bigint, l::bigint[]),
            lambda s, x: xor(t[(xor(s, x) & 255) + 1], s >> 8)), 4294967295::bigint) % {buckets} bucket from bytes, t),
        f as (select doc_id, bucket from (select doc_id, unnest(ws) w from d) join crc using (w)),
        s as (select bucket, count(*) s from f group by 1),
        g as (select bucket, count(*) t from (select unnest(ws) w from b) join crc using (w) group by 1),
        total as (select coalesce((select sum(s) from s), 0)::bigint a, coalesce((select sum(t) from g), 0)::bigint z),
        gain as (select bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * (a + {buckets})
            / ((s + 1)::double * (z + {buckets}))))::bigint gain from s left join g using (bucket), total),
        weight as (select doc_id, sum(gain)::bigint weight from f join gain using (bucket) group by 1),
        h as (select d.doc_id, len(ws)::bigint n, coalesce(weight, 0) weight,
            ('0x' || substr(sha256('{seed}:' || d.doc_id), 1, 8))::bigint h from d left join weight using (doc_id)),
        scored as (select doc_id, n, weight, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double)))::bigint score from h),
        placed as (select doc_id, row_number() over (order by score desc, doc_id) place, count(*) over () total
            from scored where n >= {least})
        select doc_id, n n_features, weight, score, case when place <= total * {percent} // 100 then place end "rank"
            from scored left join placed using (doc_id)"""


ORACLES: dict[str, str] = {
    "op1_suffix_dedup": _suffix_dedup(),
    "op5_quality_rules": _quality(),
    "op6_substring_dedup": _substring_dedup(),
    "op7_license_scan": _licenses(),
    "op11_vector_codes": _vector_codes(),
    "op12_resampling": _resampling(),
}
