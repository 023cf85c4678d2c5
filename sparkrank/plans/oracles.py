"""The registered queries in SQL, written independently of the Spark code.

Shared steps are named common table expressions; ``_sql`` puts those that a
statement needs in front of it.
"""

from __future__ import annotations

import re

from sparkrank.functions import porter2
from sparkrank.functions.text import STOP_WORDS, TOKEN_PATTERN

_RX = TOKEN_PATTERN.replace("'", "''")
_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)


def _toks(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{_RX}')"


def _draw(slot: str, *keys: str, seed: int = 42) -> str:
    text = " || '|' || ".join([f"'{seed}'", *keys, slot])
    return f"('0x' || substr(md5({text}), 1, 13))::bigint"


def _u(slot: str, *keys: str) -> str:
    return f"({_draw(slot, *keys)} / 4503599627370496.0e0)"


def _index(slot: str, size: str, *keys: str) -> str:
    return f"floor({_u(slot, *keys)} * ({size}))::bigint"


def _pick(slot: str, values: str, *keys: str) -> str:
    return f"({values})[1 + {_index(slot, f'len({values})', *keys)}]"


def _ranked(source: str, k: int, extra: str = "") -> str:
    """First k of ``source``(query_id, id, score) per query."""
    return (
        f"select * from (select query_id, id, score{extra}, row_number() over "
        f"(partition by query_id order by score desc, id) as rank from ({source})) where rank <= {k}"
    )


_METHODS = ("bm25", "vector", "hybrid", "hybrid_rrf")
_METRICS = ("precision", "recall", "mrr", "ndcg")

CTES: dict[str, str] = {
    # catalog
    "products": """
        select d.doc_id as id, split_part(text, chr(10), 1) as title,
               substr(text, length(split_part(text, chr(10), 1)) + 2) as description,
               lang as category, n_chars / 100.0e0 as price, source as brand,
               l.quality::double as rating, text
        from documents d left join labels l using (doc_id)""",
    "asked": """
        select item_id as query_id, text as query,
               case when contains(text, chr(10)) then 'multi_concept'
                    when contains(text, ',') then 'natural' end as query_type
        from benchmark""",
    "qrels": """
        select a.query_id, p.id from asked a join products p on contains(p.text, a.query)""",
    # text index
    "field_toks": f"""
        select id, 'title' as field, {_toks('title')} as toks from products
        union all select id, 'description', {_toks('description')} from products""",
    "kept_toks": f"""
        select id, field, tok from (select id, field, unnest(toks) as tok from field_toks)
        where tok not in ({_STOP})""",
    "tf": "select id, field, tok, count(*) as tf from kept_toks group by all",
    "dl": "select id, field, count(*) as dl from kept_toks group by all",
    "field_len": "select field, count(*) as n, avg(dl::double) as avgdl from dl group by field",
    "dfs": "select field, tok, count(*) as df from tf group by all",
    "asked_toks": f"""
        select query_id, tok, count(*) as qtf
        from (select query_id, unnest({_toks('query')}) as tok from asked)
        where tok not in ({_STOP}) group by all""",
    "unweighted": """
        select q.query_id, t.id, t.field,
               sum(q.qtf * ln(1 + (s.n - d.df + 0.5e0) / (d.df + 0.5e0)) * t.tf * 2.2e0
                   / (t.tf + 1.2e0 * (0.25e0 + 0.75e0 * l.dl / s.avgdl))) as s
        from asked_toks q join tf t using (tok) join dfs d using (field, tok)
             join dl l using (id, field) join field_len s using (field)
        group by all""",
    "field_scores": """
        select query_id, id, case when field = 'title' then 2.0e0 else 1.0e0 end * s as s
        from unweighted""",
    "bm25": _ranked(
        "select query_id, id, round(max(s) + 0.3e0 * (sum(s) - max(s)), 4) as score "
        "from field_scores group by all", 100),
    # vectors
    "texts": """
        select 'd' as side, id, coalesce(title, '') || '. ' || coalesce(description, '') as text from products
        union all select 'q', query_id, query from asked""",
    "slots": f"""
        select side, id, ('0x' || substr(md5(tok), 1, 8))::bigint % 64 as slot,
               sum(case when substr(md5(tok), 9, 1) < '8' then 1 else -1 end) as value
        from (select side, id, unnest({_toks('text')}) as tok from texts) group by all""",
    "lengths": "select side, id, sqrt(sum(value * value)::double) as len from slots group by all",
    "dense": """
        select t.side, t.id, pos, coalesce(s.value::double / nullif(l.len, 0), 0.0e0) as value
        from texts t cross join range(64) r(pos)
             left join slots s on s.side = t.side and s.id = t.id and s.slot = pos
             left join lengths l on l.side = t.side and l.id = t.id""",
    "vecs": """
        select side, id, list(value order by pos) as v, sqrt(sum(value * value)) as len
        from dense group by all having sum(value * value) > 0""",
    "pairs": """
        select q.id as query_id, d.id,
               round((1 + list_dot_product(q.v, d.v) / (q.len * d.len)) / 2, 6) as score
        from vecs q cross join vecs d where q.side = 'q' and d.side = 'd'""",
    "near": _ranked("from pairs", 100),
    # fusion
    "hybrid": _ranked(
        "select query_id, id, round(coalesce(t.mx, 0) + coalesce(n.score, 0), 4) as score "
        "from (select query_id, id, max(s) as mx from field_scores group by all) t "
        "full join (from near where rank <= 10) n using (query_id, id)", 10),
    "rrf": _ranked(
        "select query_id, id, round(coalesce(1e0 / (60 + a.rank), 0) "
        "+ coalesce(1e0 / (60 + b.rank), 0), 6) as score, "
        "a.rank as bm25_rank, b.rank as vector_rank "
        "from bm25 a full join near b using (query_id, id)", 10, ", bm25_rank, vector_rank"),
    "hits": """
        select query_id, 'bm25' as method, id, score, rank from bm25 where rank <= 10
        union all select query_id, 'vector', id, score, rank from near where rank <= 10
        union all select query_id, 'hybrid', id, score, rank from hybrid
        union all select query_id, 'hybrid_rrf', id, score, rank from rrf""",
    # evaluation
    "relevant": "select query_id, count(*) as n from qrels group by query_id",
    "ideal": """
        select query_id, n, sum(1 / log2(g + 1e0)) as idcg
        from relevant, range(1, 11) r(g) where g <= n group by all""",
    "judged": """
        select h.*, (r.id is not null) as rel
        from hits h left join qrels r using (query_id, id)""",
    "metrics": f"""
        select a.query_id, coalesce(a.query_type, 'unknown') as query_type, m.method,
               count(distinct j.id) filter (rel and rank <= 10) / 10e0 as precision,
               coalesce(count(distinct j.id) filter (rel and rank <= 10) * 1e0 / max(i.n), 0) as recall,
               coalesce(1e0 / min(rank) filter (rel), 0) as mrr,
               coalesce(sum(1 / log2(rank + 1e0)) filter (rel and rank <= 10) / max(i.idcg), 0) as ndcg
        from asked a cross join (select unnest({list(_METHODS)}) as method) m
             left join judged j on j.query_id = a.query_id and j.method = m.method
             left join ideal i on i.query_id = a.query_id
        group by all""",
    "by_method": "select method, "
    + ", ".join(f"avg({m}) as {m}" for m in _METRICS)
    + " from metrics group by method",
    "by_type": "select query_type, method, "
    + ", ".join(f"avg({m}) as {m}" for m in _METRICS)
    + " from metrics group by all",
    "long_method": " union all ".join(
        f"select method, '{m}' as metric, {m} as value from by_method" for m in _METRICS),
    "change": """
        select v.method, v.metric,
               case when b.value > 0 then (v.value - b.value) / b.value * 100
                    when v.value = 0 then 0 else 'inf'::double end as improvement
        from long_method v join long_method b using (metric)
        where b.method = 'bm25' and v.method <> 'bm25'""",
    # approximate search
    "planes": f"""
        select plane, axis, {_draw('axis', 'plane', seed=7)} / 2147483648.0e0 - 1 as x
        from range(192) p(plane), range(64) a(axis)""",
    "findable": """
        select d.side, d.id, d.pos, d.value from dense d join vecs v using (side, id)
        union all
        select 'q', id, pos, value from dense
        where side = 'q' and (side, id) not in (select (side, id) from vecs)""",
    "middle": "select pos, avg(value) as m from findable where side = 'd' group by pos",
    "codes": """
        select side, id, plane // 6 as band, sum(case when s > 0 then 1 << (plane % 6) else 0 end)::bigint as code
        from (select f.side, f.id, p.plane, sum((f.value - c.m) * p.x) as s
              from findable f join middle c using (pos) join planes p on p.axis = f.pos group by all)
        group by all""",
    "met": """
        select distinct q.id as query_id, d.id
        from codes q join codes d using (band, code) where q.side = 'q' and d.side = 'd'""",
    "few": "select query_id from asked where query_id not in (select query_id from met group by query_id having count(*) >= 10)",
    "approx": _ranked(
        "from pairs where (query_id, id) in (select (query_id, id) from met) "
        "or query_id in (from few)", 10),
    # ingest
    "batches": """
        select 1 as batch, p.id, p.title, p.category, p.price, p.rating, 1 as seq, e.embedding
        from products p full join embeddings e on p.id = e.vec_id
        union all
        select 2, p.id, 'new: ' || p.title, p.category, p.price, p.rating, 2, e.embedding
        from products p left join embeddings e on p.id = e.vec_id where p.rating is not null""",
    "checked": """
        select *, case when id is null then 'missing id'
                       when embedding is null then 'missing embedding'
                       when len(embedding) <> 64 then 'wrong dimension' end as reason
        from batches""",
    "stored": """
        select * exclude (place) from (
          select *, row_number() over (partition by id order by batch desc, seq desc) as place
          from checked where reason is null) where place = 1""",
    # generation
    "part_words": """
        select p_type as category, split_part(p_name, ' ', 2) as product_type,
               split_part(p_name, ' ', 1) as finish, p_name, p_brand, p_size, p_retailprice
        from part""",
    "templates": """
        select category, product_type,
               list_sort(list(distinct p_name)) as variations,
               list_sort(list(distinct p_brand)) as brands,
               list_sort(list(distinct 'size ' || p_size)) as sizes,
               list_sort(list(distinct finish)) as finishes,
               min(p_retailprice) as price_lo, max(p_retailprice) as price_hi,
               dense_rank() over (order by category) - 1 as cat_no,
               row_number() over (partition by category order by product_type) - 1 as type_no,
               count(*) over (partition by category) as types
        from part_words group by category, product_type""",
    "cats": "select distinct cat_no, types, (select count(distinct category) from templates) as c from templates",
    "places": f"""
        select slot, slot - 1 < share * c as shared, share, (slot - 1) % share as inside,
               case when slot - 1 < share * c then (slot - 1) // share
                    else {_index("'category'", 'c', 'slot')} end as cat_no
        from (select unnest(range(1, n + 1)) as slot, n // c as share, c
              from (select count(*) as n, (select max(c) from cats) as c from part))""",
    "typed": f"""
        select slot, cat_no,
               case when shared and inside < (share // types) * types then inside // (share // types)
                    else {_index("'type'", 'types', 'slot')} end as type_no
        from places join cats using (cat_no)""",
    "picked": f"""
        select slot, t.*, {_pick("'base'", 'list_concat([product_type], variations)', 'slot')} as variation,
               {_pick("'brand'", 'brands', 'slot')} as brand,
               {_pick("'attr:size'", 'sizes', 'slot')} as size,
               {_pick("'attr:finish'", 'finishes', 'slot')} as one_finish,
               {_u("'rating'", 'slot')} as ur
        from typed join templates t using (cat_no, type_no)""",
    "made": f"""
        select printf('prod_%05d', slot) as id,
               trim(brand || ' ' || array_to_string(list_transform(
                 regexp_extract_all(variation, '\\p{{L}}+|[^\\p{{L}}]+'),
                 lambda w: upper(w[1]) || lower(w[2:])), '') || ' - ' || size, ' -') as title,
               replace(replace(replace({_pick("'description'", "['A {variation} in {finish} finish, {size}.', 'This {variation} comes as {size}. Choose {finish}.']", 'slot')},
                 '{{variation}}', variation), '{{finish}}', one_finish), '{{size}}', size) as description,
               category, round(price_lo + {_u("'price'", 'slot')} * (price_hi - price_lo), 2) as price,
               brand,
               round(case when ur <= 0.75e0 then 3 + sqrt(3 * ur) else 5 - sqrt(1 - ur) end, 1) as rating,
               product_type, size, one_finish as finish
        from picked""",
    "numbered": f"""
        select category, product_type, id,
               row_number() over (partition by category, product_type
                                  order by {_draw("'index'", 'id')}, id) - 1 as pos
        from made""",
    "stock": "select category, product_type, count(*) as n from made group by all",
    "wishes": f"""
        select *, row_number() over (partition by stage order by {_draw("'template'", 'query', 'category')}, query) - 1 as template_no
        from (
          select distinct 0 as stage, lower(category || ' ' || p_name) as query, category,
                 [product_type] as targets, 'keyword' as query_type from part_words
          union all
          select 1, 'anything ' || lower(category) || ' by ' || lower(p_brand), category,
                 list_concat(list_sort(list(distinct product_type)), ['gift']), 'natural'
          from part_words group by category, p_brand
          union all
          select 1, 'goods of ' || lower(r_name), r_name, ['ring'], 'synonym' from region)""",
    "wanted": """
        select stage, template_no, category, unnest(targets) as product_type from wishes""",
    "matched": "select w.* from wanted w join stock using (category, product_type)",
    "template_asked": """
        select *, printf('query_%03d', query_no + 1) as query_id from (
          select w.*, row_number() over (order by stage, template_no) - 1 as query_no
          from wishes w where (stage, template_no) in (select (stage, template_no) from matched))
        where stage = 0 or query_no < {n}""",
    "fillers": f"""
        select no, t.category, t.product_type, variation, brand, style,
               case when attr = 'size' then {_pick("'q-value'", 'sizes', 'no')}
                    else {_pick("'q-value'", 'finishes', 'no')} end as value
        from (
          select no, t.*, {_pick("'q-variation'", 'variations', 'no')} as variation,
                 {_pick("'q-brand'", 'brands', 'no')} as brand,
                 {_index("'q-style'", '3', 'no')} as style,
                 {_pick("'q-attribute'", "['finish', 'size']", 'no')} as attr
          from (select no, cat_no, {_index("'q-type'", 'types', 'no')} as type_no
                from (select unnest(range(k + 1, {{n}} + 1)) as no,
                             {_index("'q-category'", 'c', 'no')} as cat_no
                      from (select (select count(*) from template_asked) as k, (select max(c) from cats) as c))
                     join cats using (cat_no))
               join templates t using (cat_no, type_no)) t""",
    "all_asked": """
        select query_id, query, query_type from template_asked
        union all
        select printf('query_%03d', no),
               case style when 0 then brand || ' ' || variation when 1 then 'best ' || variation
                          else variation || ' ' || value end, 'generated'
        from fillers""",
    "goals": """
        select a.query_id, m.category, m.product_type
        from template_asked a join matched m using (stage, template_no)
        union all select printf('query_%03d', no), category, product_type from fillers""",
    "sized": f"""
        select g.*, n, least(5 + {_index("'relevant'", '11', 'query_id', 'product_type')}, n) as size
        from goals g join stock using (category, product_type)""",
    "drawn": f"""
        select query_id, category, product_type, unnest(list_reduce(
            list_transform(range(n - size, n), lambda j: [j]),
            lambda acc, x: case
              when list_contains(acc, {_index("'s' || x[1]", 'x[1] + 1', 'query_id', 'product_type')})
              then list_concat(acc, x)
              else list_concat(acc, [{_index("'s' || x[1]", 'x[1] + 1', 'query_id', 'product_type')}]) end,
            []::bigint[])) as pos
        from sized""",
    "made_qrels": "select query_id, id from drawn join numbered using (category, product_type, pos)",
}


# --- English stemming as regular expressions over a vocabulary ---------------

_V = "[aeiouy]"
_SHORT = (
    "(regexp_matches({w}, '^[aeiouy][^aeiouy]$') "
    "or regexp_matches({w}, '[^aeiouy][aeiouy][^aeiouywxY]$'))"
)
_REGION = f"^[^aeiouy]*{_V}+[^aeiouy]"


def _quoted(word: str) -> str:
    return "'" + word.replace("'", "''") + "'"


def _table(pairs: dict[str, str]) -> str:
    return "map {" + ", ".join(f"{_quoted(k)}: {_quoted(v)}" for k, v in pairs.items()) + "}"


def _cut(w: str, n: str) -> str:
    return f"substr({w}, 1, greatest(length({w}) - {n}, 0))"


def _step(name: str, before: str, suffixes, case: str) -> str:
    """One step over (tok, w, r1, r2): ``case`` sees the suffix s and the base b."""
    longest = "|".join(sorted(suffixes, key=len, reverse=True))
    return (
        f"{name} as (select tok, r1, r2, case {case} else w end as w from ("
        f"select *, substr(w, 1, length(w) - length(s)) as b from ("
        f"select *, regexp_extract(w, '({longest})$') as s from {before})))"
    )


def _stems(vocabulary: str) -> str:
    """Statement for (tok, stem) of the tokens of ``vocabulary``(tok)."""
    plain = ", ".join(_quoted(w) for w in porter2.WHOLE_WORDS)
    held = ", ".join(_quoted(w) for w in porter2.AFTER_PLURAL)
    prefixes = "|".join(porter2.REGION_PREFIXES)
    doubles = "|".join(porter2.DOUBLES)
    steps = [
        f"st_word as (select tok, replace(tok, '’', chr(39)) as o from ({vocabulary}))",
        "st_marked as (select tok, regexp_replace(regexp_replace(regexp_replace("
        f"o, '^''', ''), '^y', 'Y'), '({_V})y', '\\1Y', 'g') as w "
        f"from st_word where length(o) > 2 and o not in ({plain}))",
        f"st_r1 as (select tok, w, case when regexp_matches(w, '^({prefixes})') "
        f"then length(regexp_extract(w, '^({prefixes})')) when regexp_matches(w, '{_REGION}') "
        f"then length(regexp_extract(w, '{_REGION}')) else length(w) end as r1 from st_marked)",
        f"st_r2 as (select tok, w, r1, case when regexp_matches(substr(w, r1 + 1), '{_REGION}') "
        f"then r1 + length(regexp_extract(substr(w, r1 + 1), '{_REGION}')) "
        "else length(w) end as r2 from st_r1)",
        "st_0 as (select tok, r1, r2, regexp_replace(w, '(''s''|''s|'')$', '') as w from st_r2)",
        f"st_1a as (select tok, r1, r2, case when w like '%sses' then {_cut('w', '2')} "
        "when w like '%ied' or w like '%ies' "
        f"then {_cut('w', 'case when length(w) > 4 then 2 else 1 end')} "
        "when w like '%us' or w like '%ss' then w "
        f"when w like '%s' and regexp_matches({_cut('w', '2')}, '{_V}') then {_cut('w', '1')} "
        "else w end as w from st_0)",
        f"st_held as (select tok, w from st_1a where w in ({held}))",
        f"st_go as (select * from st_1a where w not in ({held}))",
        _step(
            "st_1b", "st_go", ("eed", "eedly", "ed", "edly", "ing", "ingly"),
            "when s = '' then w "
            "when s like 'eed%' then case when length(b) >= r1 then b || 'ee' else w end "
            f"when not regexp_matches(b, '{_V}') then w "
            "when regexp_matches(b, '(at|bl|iz)$') then b || 'e' "
            f"when regexp_matches(b, '({doubles})$') then {_cut('b', '1')} "
            f"when {_SHORT.format(w='b')} and r1 >= length(b) then b || 'e' when true then b",
        ),
        "st_1c as (select tok, r1, r2, case when length(w) > 2 and regexp_matches(w, '[^aeiouy][yY]$') "
        f"then {_cut('w', '1')} || 'i' else w end as w from st_1b)",
        _step(
            "st_2", "st_1c", porter2.STEP2,
            "when s <> '' and length(b) >= r1 and (s <> 'ogi' or b like '%l') "
            "and (s <> 'li' or regexp_matches(b, '[cdeghkmnrt]$')) "
            f"then b || ({_table(porter2.STEP2)})[s]",
        ),
        _step(
            "st_3", "st_2", porter2.STEP3,
            "when s <> '' and length(b) >= case when s = 'ative' then r2 else r1 end "
            f"then b || ({_table(porter2.STEP3)})[s]",
        ),
        _step(
            "st_4", "st_3", porter2.STEP4,
            "when s <> '' and length(b) >= r2 and (s <> 'ion' or regexp_matches(b, '[st]$')) then b",
        ),
        "st_5 as (select tok, case when w like '%e' and (length(w) - 1 >= r2 or "
        f"(length(w) - 1 >= r1 and not {_SHORT.format(w=_cut('w', '1'))})) then {_cut('w', '1')} "
        f"when w like '%ll' and length(w) - 1 >= r2 then {_cut('w', '1')} else w end as w from st_4)",
    ]
    return (
        f"with {', '.join(steps)} "
        "select tok, replace(w, 'Y', 'y') as stem from st_5 "
        "union all select tok, replace(w, 'Y', 'y') from st_held "
        "union all select tok, o from st_word where length(o) <= 2 "
        f"union all select tok, ({_table(porter2.WHOLE_WORDS)})[o] from st_word where o in ({plain})"
    )


NUM_QUERIES = "(select count(*) from wishes)"
CAPPED_QUERIES = "(select count(*) filter (stage = 0) + count(*) filter (stage <> 0) // 2 from wishes)"
FILLED_QUERIES = "(select count(*) + count(*) // 3 + 1 from wishes)"


def _sql(final: str, n: str | None = None, other: dict[str, str] | None = None) -> str:
    """``final`` after the expressions it needs.

    ``n`` fills in the number of queries, ``other`` replaces expressions by name.
    """
    bodies = {**CTES, **(other or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in bodies.items():
            used = rf"\b(from|join)\s+{name}\b|,\s*{name}\b(?=\s*(,|where|$))"
            if name not in needed and re.search(used, text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(final)
    ctes = ", ".join(f"{name} as ({bodies[name].strip()})" for name in needed)
    statement = f"with {ctes} {final}" if ctes else final
    return statement.replace("{n}", str(n)) if n is not None else statement


# The generated catalog in place of the documents; its vectors are stored as FLOAT.
_GENERATED = {
    "products": "select *, description as text from made",
    "asked": "select query_id, query, query_type from all_asked",
    "qrels": "select query_id, id from made_qrels",
    "dense": CTES["dense"].replace("0.0e0) as value", "0.0e0)::float::double as value"),
}


# The catalog after the batch of ``index_after_upsert``.
_CHANGED = ", ".join(f"{c}" for c in ("description", "category", "price", "brand", "rating", "text"))
_UPSERTED = {
    "products": f"""
        select id, case when id % 10 = 0 then brand || ' ' || category else title end as title, {_CHANGED}
        from ({CTES['products']}) where id % 10 <> 5
        union all select id + 1000000000, title, {_CHANGED} from ({CTES['products']}) where id % 10 = 1""",
}

# The full analyser: tokens of both sides replaced by their stems.
_STEMMED = {
    "whole_toks": CTES["kept_toks"],
    "vocabulary": f"select tok from whole_toks union select unnest({_toks('query')}) from asked",
    "stems": _stems("from vocabulary"),
    "kept_toks": "select id, field, stem as tok from whole_toks join stems using (tok)",
    "asked_toks": f"""
        select query_id, stem as tok, count(*) as qtf
        from (select query_id, unnest({_toks('query')}) as tok from asked) join stems using (tok)
        where tok not in ({_STOP}) group by query_id, stem""",
}


def _grid(k: int, width: int, cell: str) -> str:
    columns = ", ".join(
        f"coalesce(max({cell}) filter (method = '{m}'), '-') as {m}" for m in _METHODS[:3]
    )
    return (
        f"select query_id, rank, {columns} from (select h.*, substr(p.title, 1, {width}) as t "
        f"from hits h join products p using (id)) where rank <= {k} "
        f"and method <> 'hybrid_rrf' group by query_id, rank"
    )


_ALL_ROUNDED = ", ".join(f"round({m}, 6) as {m}" for m in _METRICS)
_DOC = "id, title, description, category, price, brand, rating, brand as attr_source"
_SCORE2 = "round(score::decimal(18,6), 2)::decimal(18,2)::varchar"
_SCORE3 = "round(score::decimal(18,6), 3)::decimal(18,3)::varchar"

_ALL_TOKENS = f"""
    select id, pos - 1 as pos, toks[pos] as tok
    from (select id, toks, unnest(range(1, len(toks) + 1)) as pos
          from (select doc_id as id, {{kept}} as toks from documents))"""

ORACLES: dict[str, str] = {
    "scan_catalog": _sql(f"select {_DOC} from products"),
    "scan_queries_qrels": _sql(
        "select a.query_id, a.query, a.query_type, r.id from asked a left join qrels r using (query_id)"),
    "embedded_only": _sql(
        "select p.id, p.title, len(e.embedding) as dim from products p join embeddings e on p.id = e.vec_id"),
    "embedding_coverage": (
        "select count(*) as total, count(embedding) as embedded, count(*) - count(embedding) as missing "
        "from documents left join embeddings on doc_id = vec_id"),
    "scan_json_array": _sql(f"select {_DOC} from products"),
    "roundtrip_catalog": _sql(f"select {_DOC} from products"),
    "roundtrip_vectors": (
        "select doc_id as id, p - 1 as pos, embedding[p]::double as value from ("
        "select doc_id, embedding, unnest(range(1, len(embedding) + 1)) as p "
        "from documents join embeddings on doc_id = vec_id)"),
    "to_documents": _sql(
        "select id, title, category, brand, price, '' as product_type, 2::bigint as attributes from products"),
    "ingest_upsert": _sql(
        "select id, title, category, price, rating, seq::bigint as seq, batch::bigint as batch from stored"),
    "ingest_stats": _sql(
        "select count(*) as total, count(*) filter (reason is null) as success, count(reason) as failed from checked"),
    "ingest_rejects": _sql(
        "select batch::bigint as batch, id, reason from checked where reason is not null"),
    "reject_sample": _sql(
        "select batch::bigint as batch, id, reason from checked where reason is not null "
        "order by batch, id nulls first, reason limit 5"),
    "ingest_streaming": _sql(
        "select id, title, category, price from products where id in (select vec_id from embeddings)"),
    "verify_ingest": _sql(
        "select n, expected, without_vector, min_dim, max_dim, self_score, "
        "(n = expected and without_vector = 0 and min_dim = max_dim and self_score = 1) as ok from "
        "(select count(*) as n, count(*) filter (len(embedding) = 0) as without_vector, "
        "min(len(embedding)) as min_dim, max(len(embedding)) as max_dim from stored), "
        "(select count(*) as expected from products where id in (select vec_id from embeddings)), "
        "(select min(best) as self_score from (select a.id, max(round((1 + list_cosine_similarity("
        "a.embedding::double[], b.embedding::double[])) / 2, 6)) as best "
        "from (from stored order by id limit 3) a cross join (from stored) b group by a.id))"),
    "sample_docs": _sql("select id, title, category from products order by id limit 3"),
    "index_stats": _sql(
        "select f.field, f.n as docs, t.terms, t.postings, round(f.avgdl, 6) as avgdl, "
        "(select count(*) from vecs where side = 'd') as vectors, 64::bigint as dim "
        "from field_len f join (select field, count(*) as terms, sum(df)::bigint as postings "
        "from dfs group by field) t using (field)"),
    "gen_products": _sql("select * from made"),
    "gen_ratings": _sql("select rating, count(*) as n from made group by rating"),
    "index_mapping": _sql(" union all ".join(
        f"select '{field}' as field, '{kind}' as kind, {analyser} as analyser, {weight}::double as weight, "
        f"null::bigint as dim, null as encoder, count({field}) as filled from products"
        for field, kind, analyser, weight in [
            ("id", "bigint", "null", "null"), ("title", "text", "'words, stop words'", "2"),
            ("description", "text", "'words, stop words'", "1"), ("category", "keyword", "null", "null"),
            ("price", "double", "null", "null"), ("brand", "keyword", "null", "null"),
            ("rating", "double", "null", "null"),
        ]
    ) + " union all select 'attributes', 'object', null, null, null, null, count(*) from products"
        " union all select 'product_type', 'keyword', null, null, null, null, 0"
        " union all select 'embedding', 'vector', null, null, 64, 'hashed words', count(*) from vecs where side = 'd'"),
    "gen_quota": _sql("select category, product_type, n from stock"),
    "gen_shuffled": _sql("select id, title from made"),
    "product_index": _sql("select category, product_type, pos, id from numbered"),
    "gen_queries": _sql(
        "select a.query_id, a.query, a.query_type, count(*) as n_relevant "
        "from all_asked a join made_qrels q using (query_id) group by all", NUM_QUERIES),
    "gen_capped_queries": _sql("select query_id, query, query_type from template_asked", CAPPED_QUERIES),
    "sample_qrels": _sql("select query_id, id from made_qrels", NUM_QUERIES),
    "gen_filler_queries": _sql(
        "select a.query_id, a.query, a.query_type, count(*) as n_relevant "
        "from all_asked a join made_qrels q using (query_id) where a.query_type = 'generated' group by all",
        FILLED_QUERIES),
    "query_type_counts": _sql(
        "select query_type, count(*) as n from all_asked group by query_type", FILLED_QUERIES),
    "gen_unmatched_targets": _sql(
        "select w.query, w.category, x.product_type from wishes w "
        "join wanted x using (stage, template_no) "
        "where (x.category, x.product_type) not in (select (category, product_type) from stock)"),
    "combined_text": _sql("select id, coalesce(title, '') || '. ' || coalesce(description, '') as text from products"),
    "embed_hashed": _sql("select id, pos, round(value, 6) as value from dense where side = 'd'"),
    "embed_queries": _sql(
        "select id as query_id, pos, round(value, 6) as value from dense where side = 'q'"),
    "embed_plugin": _sql(
        "select id, pos, [length(text), "
        + ", ".join(f"length(text) - length(replace(text, {c}, ''))" for c in ("' '", "chr(10)", "','"))
        + "][pos + 1]::double as value from texts cross join range(4) r(pos) where side = 'd'"),
    "attach_embeddings": _sql(
        "select p.id, p.title, round(e.embedding[1]::double, 6) as first_value "
        "from products p left join embeddings e on p.id = e.vec_id"),
    "embedding_stats": (
        "select count(*) as n, min(len(embedding)) as min_dim, max(len(embedding)) as max_dim, "
        "sum(len(embedding))::bigint as total_values from embeddings"),
    "embedding_preview": (
        "select vec_id as id, p - 1 as pos, embedding[p]::double as value "
        "from (select vec_id, embedding, unnest(range(1, 11)) as p from embeddings "
        "where vec_id = (select min(vec_id) from embeddings))"),
    "tokens": _ALL_TOKENS.format(kept=_toks("text")),
    "tokens_nostop": _ALL_TOKENS.format(
        kept=f"list_filter({_toks('text')}, lambda t: t not in ({_STOP}))"),
    "stem_vocabulary": _stems(
        f"select distinct tok from (select unnest({_toks('text')}) as tok from documents) "
        f"where tok not in ({_STOP})"),
    "postings": _sql("select id, field, tok, tf, dl from tf join dl using (id, field)"),
    "field_stats": _sql("select field, n, round(avgdl, 6) as avgdl from field_len"),
    "term_idf": _sql(
        "select field, tok, df, round(ln(1 + (n - df + 0.5e0) / (df + 0.5e0)), 6) as idf "
        "from dfs join field_len using (field)"),
    "filter_keyword": _sql(
        "select id, title, category, brand from products where category = 'fr' and brand = 'src7'"),
    "filter_range": _sql(
        "select id, price, rating from products where price between 5 and 20 and rating >= 1"),
    "filter_attribute": _sql("select id, title from products where brand = 'src3'"),
    "facet_counts": _sql(
        "select 'category' as facet, category as value, count(*) as n from products group by all "
        "union all select 'brand', brand, count(*) from products group by all"),
    "sort_title_keyword": _sql(
        "select id, case when length(title) <= 256 then title end as title_keyword from products"),
    "attribute_facets": _sql(
        "select 'lang' as attribute, category as value, count(*) as n from products group by all "
        "union all select 'source', brand, count(*) from products group by all"),
    "bm25_topk": _sql("select * from bm25 where rank <= 10"),
    "index_after_upsert": _sql("select * from bm25 where rank <= 10", other=_UPSERTED),
    "bm25_title_only": _sql(_ranked(
        "select query_id, id, round(s, 4) as score from unweighted where field = 'title'", 10)),
    "bm25_stemmed": _sql("select * from bm25 where rank <= 10", other=_STEMMED),
    "knn_exact": _sql("select * from near where rank <= 10"),
    "knn_text": _sql("select * from near where rank <= 10"),
    "knn_bounded": _sql("select * from near where rank <= 10"),
    "knn_cells_recall": _sql(
        "select count(*) as wanted, 0::bigint as wrong_scores, true as most_found from near where rank <= 10"
    ),
    "knn_precomputed": (
        "with m as (select label, list(x order by p) as q from (select label, p, avg(embedding[p]::double) as x "
        "from embeddings, range(1, 65) r(p) group by all) group by label) "
        + _ranked(
            "select label::bigint as query_id, vec_id as id, round((1 + list_cosine_similarity("
            "q, embedding::double[])) / 2, 6) as score from m cross join (select vec_id, embedding from embeddings)",
            10)),
    "knn_approx": _sql("select * from approx"),
    "band_table": _sql("select id, band, code from codes where side = 'd'"),
    "knn_recall": _sql(
        "select round((select count(*) from approx join near using (query_id, id) where near.rank <= 10) "
        "/ (select count(*) from near where rank <= 10)::double, 6) as recall, "
        "round((select count(*) from met) / (select count(*) from pairs)::double, 6) as candidate_share"),
    "hybrid_linear": _sql("select * from hybrid"),
    "hybrid_rrf": _sql("select * from rrf"),
    "format_hits": _sql(
        "select id, title, description, category, brand, price, products.rating, query_id, "
        "method as search_type, score, rank from hits join products using (id)"),
    "compare_methods": _sql("select * from hits where rank <= 5 and method <> 'hybrid_rrf'"),
    "side_by_side": _sql(_grid(5, 45, f"t || ' | ' || {_SCORE3}")),
    "side_by_side_report": _sql(_grid(
        5, 24, f"t || ' (' || case when method = 'vector' then {_SCORE3} else {_SCORE2} end || ')'")),
    "category_hits": _sql(
        "select query_id, method, category, count(*) as n, "
        "count(*) over (partition by query_id, method) as categories "
        "from hits join products using (id) where rank <= 5 group by query_id, method, category"),
    "precision_at_k": _sql("select query_id, method, round(precision, 6) as precision from metrics"),
    "recall_at_k": _sql("select query_id, method, round(recall, 6) as recall from metrics"),
    "reciprocal_rank": _sql("select query_id, method, round(mrr, 6) as mrr from metrics"),
    "ndcg_at_k": _sql("select query_id, method, round(ndcg, 6) as ndcg from metrics"),
    "dcg_graded": _sql(
        "select h.query_id, h.method, round(sum(case when r.id is null then 0 "
        "else (1 + coalesce(p.rating, 0)) / log2(h.rank + 1e0) end), 6) as dcg "
        "from hits h left join qrels r using (query_id, id) left join products p using (id) group by all"),
    "metrics_per_query": _sql(f"select query_id, query_type, method, {_ALL_ROUNDED} from metrics"),
    "metrics_by_method": _sql(f"select method, {_ALL_ROUNDED} from by_method"),
    "metrics_one_method": _sql(f"select method, {_ALL_ROUNDED} from by_method where method = 'hybrid'"),
    "metrics_by_type": _sql(f"select query_type, method, {_ALL_ROUNDED} from by_type"),
    "metrics_rollup": _sql(
        "select query_type, method, grouping_id(query_type, method)::bigint as level, count(*) as queries, "
        + ", ".join(f"round(avg({m}), 6) as {m}" for m in _METRICS)
        + " from metrics group by rollup (query_type, method)"),
    "improvement_over_baseline": _sql("select method, metric, round(improvement, 6) as improvement from change"),
    "metrics_grid": _sql(
        "select metric, method, round(round(value, 9), 4) as value, round(round(improvement, 9), 1) as improvement "
        "from long_method left join change using (metric, method)"),
    "chart_data_by_method": _sql("select metric, " + ", ".join(
        f"round(coalesce(max(value) filter (method = '{m}'), 0), 6) as {m}" for m in _METHODS)
        + " from long_method group by metric"),
    "chart_data_by_type": _sql("select query_type, " + ", ".join(
        f"round(coalesce(max(mrr) filter (method = '{m}'), 0), 6) as {m}" for m in _METHODS)
        + " from by_type group by query_type"),
    "flow_improvements": _sql(
        "select method, metric, round(improvement, 6) as improvement from change", FILLED_QUERIES, _GENERATED),
    "flow_report": _sql(_grid(
        5, 24, f"t || ' (' || case when method = 'vector' then {_SCORE3} else {_SCORE2} end || ')'"),
        FILLED_QUERIES, _GENERATED),
    "flow_category_hits": _sql(
        "select query_id, method, category, count(*) as n, "
        "count(*) over (partition by query_id, method) as categories "
        "from hits join products using (id) where rank <= 5 group by query_id, method, category",
        FILLED_QUERIES, _GENERATED),
    "flow_by_type": _sql(f"select query_type, method, {_ALL_ROUNDED} from by_type", FILLED_QUERIES, _GENERATED),
}
