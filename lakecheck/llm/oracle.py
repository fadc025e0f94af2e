"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from lakecheck.llm import mixing, quality_rules

WORD = r"[^\x20\x09-\x0D]+"


def _quality() -> str:
    stop = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)
    rules = " and ".join(
        f"({whole} = 0 or (" + " and ".join([f"{part} * 1000 >= {whole} * {least}"] * (least is not None)
                                              + [f"{part} * 1000 <= {whole} * {most}"] * (most is not None)) + "))"
        for _, part, whole, least, most in quality_rules.THRESHOLDS)
    return f"""
    with t as (select doc_id, coalesce(text, '') as text from documents),
    w as (select doc_id, text, regexp_extract_all(text, '{WORD}') as words,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from t),
    win as (select doc_id, unnest(generate_series(1, len(words) - 7)) as i, words from w where len(words) >= 8),
    hashed as (select doc_id, i, array_to_string(words[i:i + 7], ' ') as s from win),
    starts as (select doc_id, i from hashed qualify count(*) over (partition by doc_id, s) > 1),
    cover as (select doc_id, sum(least(8, coalesce(nxt - i, 8))) as n from
                (select doc_id, i, lead(i) over (partition by doc_id order by i) as nxt from starts) group by doc_id),
    m as (select w.doc_id, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
                 len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
                 len(regexp_extract_all(text, '!'))::bigint as n_exclaims,
                 len(regexp_extract_all(text, '\\p{{Lu}}'))::bigint as n_upper,
                 len(list_filter(words, lambda x: lower(x) in ({stop})))::bigint as n_stop_words,
                 len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
                 coalesce(cover.n, 0)::bigint as n_repeat_words
          from w left join cover using (doc_id)),
    b as (select *, (n_words < 20 or 100 * n_repeat_words > 30 * n_words) as base_failed from m)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           (not base_failed and {rules}) as kept from b"""


def _mixing() -> str:
    dims = list(mixing.TARGETS)
    keys = ", ".join(f"k_{d}" for d in dims)
    ctes = [f"""f as (select doc_id, source, lang,
        case when contains(t, 'icense') or contains(t, 'rights reserved') then 'legal' when contains(t, '@') then 'contact'
             when contains(t, ' | ') then 'listing' else 'prose' end as topic,
        len(regexp_extract_all(t, '{WORD}'))::bigint as n_tokens
        from (select *, coalesce(text, '') as t from documents))""",
            "k as (select *, " + ", ".join(f"coalesce({d}, chr(1) || 'null') as k_{d}" for d in dims) + " from f)",
            f"c0 as (select {keys}, sum(n_tokens)::bigint as mass, sum(n_tokens)::double as raked from k group by all having sum(n_tokens) > 0)",
            "tot as (select sum(mass)::double as total from c0)"]
    for d, t in mixing.TARGETS.items():
        p = ("case k_" + d + " " + " ".join(f"when '{k}' then {v}::double" for k, v in t.items()) + " end"
             if isinstance(t, dict) else f"pow(sum(mass)::double, {float(t)})")
        # values that are not listed (p is NULL) keep their observed share, the listed ones share the rest
        ctes.append(f"""g_{d} as (select k_{d}, case when p is null then m / whole else p / coalesce(nullif(norm, 0), 1) * (1 - other / whole) end as g from (
            select *, coalesce(nullif(case when norm <> 0 then (select total from tot) else other end, 0), 1.0) as whole from (
                select *, coalesce(sum(p) over (), 0.0) as norm, coalesce(sum(case when p is null then m end) over (), 0.0) as other from (
                    select k_{d}, {p} as p, sum(mass)::double as m from c0 group by k_{d}))))""")
    at = "c0"
    for s in range(mixing.SWEEPS):
        for d in dims:
            ctes.append(f"c_{s}_{d} as materialized (select {', '.join(f'x.k_{e}' for e in dims)}, mass, case when now > 0 then raked * (total * g / now) else 0 end as raked "
                        f"from (select *, sum(raked) over (partition by k_{d}) as now from {at}) x join g_{d} using (k_{d}), tot)")
            at = f"c_{s}_{d}"
    ctes.append(f"e as (select k.*, coalesce(round(raked / mass, 9), 1.0) as factor, "
                f"('0x' || substr(md5(coalesce(doc_id::varchar, 'NULL') || ':0'), 1, 8))::bigint / 4294967296.0 as u from k left join {at} using ({keys}))")
    return "with " + ",\n".join(ctes) + """
    select doc_id, source, lang, topic, n_tokens, round(factor, 6) as factor, round(least(1.0, factor), 6) as probability,
           (floor(factor) + (u < factor - floor(factor))::int)::bigint as copies,
           (floor(factor) + (u < factor - floor(factor))::int) > 0 as sampled from e"""


def _crc_step() -> str:
    """One step of nine a character: a character comes in, then its eight bits are divided out (polynomial 0xEDB88320)."""
    return ("case when k % 9 = 0 then xor(c, ascii(s[k // 9 + 1])::bigint) when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end")


def _merkle(levels: int = 9, tops: int = 6) -> str:
    """Levels are written out: for groups of up to 8**levels rows and 8**tops groups."""
    field = lambda c: f"case when {c} is null then '-' else strlen({c}::varchar) || ':' || {c}::varchar end"
    leaf = lambda text: "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    ctes = ["""base as (select *, row_number() over () as row_key from documents)""",
            """bits as (select row_key, doc_id::varchar as s, 0 as k, 4294967295::bigint as c from base where doc_id is not null
               union all select row_key, s, k + 1, """ + _crc_step() + """ from bits where k < 9 * length(s))""",
            "crcs as (select row_key, xor(c, 4294967295) as crc from bits where k = 9 * length(s))",
            f"""leaves as (select row_key, doc_id, lang, {leaf('text')} as leaf, case when crc % 3 = 0 then {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
                 else {leaf('text')} end as found from base left join crcs using (row_key))""",
            """l0 as (select *, dense_rank() over (order by lang nulls first) - 1 as tree,
                 row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos from leaves)""",
            "n0 as (select tree, pos, leaf as h, count(*) over (partition by tree) as n from l0)"]
    def climb(n: str, s: str, depth: int) -> None:
        for k in range(depth):
            ctes.append(f"""{s}{k} as (select tree, pos, case when n > 1 then coalesce(string_agg(h, '') over (partition by tree, pos // 8 order by pos
                rows between unbounded preceding and 1 preceding), '') else '' end as before, case when n > 1 then coalesce(string_agg(h, '') over (partition by tree, pos // 8
                order by pos rows between 1 following and unbounded following), '') else '' end as after, n > 1 as on_path from {n}{k})""")
            ctes.append(f"""{n}{k + 1} as (select tree, pos // 8 as pos, case when any_value(n) > 1 then sha256(string_agg(h, '' order by pos)) else any_value(h) end as h,
                any_value((n + 7) // 8) as n from {n}{k} group by tree, pos // 8)""")
    climb("n", "s", levels)
    ctes.append(f"t0 as (select 0 as tree, tree as pos, h, count(*) over () as n from n{levels})")
    climb("t", "u", tops)
    path = [("s", k, f"s{k}.tree = r.tree and s{k}.pos = r.pos // {8 ** k}") for k in range(levels)] + [
        ("u", k, f"u{k}.pos = r.tree // {8 ** k}") for k in range(tops)]
    ctes.append("f0 as (select r.*, r.found as h0, '' as sib0 from l0 r)")
    for x, (s, k, on) in enumerate(path):
        ctes.append(f"""f{x + 1} as (select r.* exclude (h{x}, sib{x}), case when {s}{k}.on_path then sha256({s}{k}.before || r.h{x} || {s}{k}.after) else r.h{x} end as h{x + 1},
            r.sib{x} || {s}{k}.before || {s}{k}.after as sib{x + 1} from f{x} r join {s}{k} on {on})""")
    z = len(path)
    return "with recursive " + ",\n".join(ctes) + f"""
    select r.doc_id, r.leaf, sub.h as subroot, top.h as root, sha256(r.sib{z}) as proof_sha256, r.h{z} as folded_root, r.h{z} = top.h as verified
    from f{z} r join n{levels} sub on sub.tree = r.tree, t{tops} top"""


def _ranked() -> str:
    return """
    with d as (select row_number() over () as rk, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms from documents where text is not null),
    n as (select rk, doc_id, len(terms)::bigint as n from d where len(terms) > 0),
    total as (select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from n),
    tf as (select rk, term, count(*)::bigint as tf from (select rk, unnest(terms) as term from d) group by all),
    df as (select term, count(*)::bigint as df from tf group by term),
    m as (select rk, doc_id, 25 + (75 * n * n_docs) // n_terms as m from n, total),
    q as (select row_number() over () as item, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms from benchmark where text is not null),
    asked as (select item, item_id, term, count(*)::bigint as c from (select item, item_id, unnest(terms) as term from q) group by all),
    weighted as (select item, item_id, term, c * floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::bigint as w from asked join df using (term), total),
    scored as (select item, item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
               from weighted join tf using (term) join m using (rk) group by item, item_id, rk, doc_id)
    select item_id, row_number() over (partition by item order by score desc, doc_id)::int as rank, doc_id, score from scored where score > 0
    qualify rank <= 10"""


def oracle_sql() -> dict[str, str]:
    return {"op7_quality_rules": _quality(), "op10_mixing": _mixing(), "op11_merkle_manifest": _merkle(), "op12_ranked_search": _ranked()}
