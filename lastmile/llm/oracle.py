"""DuckDB SQL for the numbered operators whose result SQL can express."""

from __future__ import annotations

from lastmile.llm.licenses import TEMPLATES

OP7 = r"""
with recursive docs as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents
), sets as (
  select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ')
    else array_to_string(w[i : i + 4], ' ') end as s
  from docs, unnest(range(1, greatest(len(w) - 3, 2))) r(i)
  where len(w) > 0
), sizes as (
  select doc_id, count(*) as n from sets group by doc_id
), shared as (
  select x.doc_id as a, y.doc_id as b, count(*) as m
  from sets x join sets y on x.s = y.s and x.doc_id <> y.doc_id group by 1, 2
), links as (
  select a, b from shared join sizes p on p.doc_id = a join sizes q on q.doc_id = b
  where 100 * m >= 75 * (p.n + q.n - m)
), reach as (
  select doc_id as a, doc_id as b from documents
  union
  select reach.a, links.b from reach join links on links.a = reach.b
), component as (
  select a as doc_id, min(b) as component_id from reach group by a
)
select d.doc_id, coalesce(z.n, 0) as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from documents d join component c using (doc_id) left join sizes z using (doc_id)
"""


OP4 = r"""
with recursive vectors as (
  select vec_id, label, cast(embedding as double[]) as e, len(embedding) as n from embeddings
  where label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select x.vec_id as a, y.vec_id as b from vectors x join vectors y
  on x.label = y.label and x.n = y.n and x.vec_id <> y.vec_id
  and list_dot_product(x.e, y.e) / sqrt(list_dot_product(x.e, x.e) * list_dot_product(y.e, y.e)) >= 0.93
), reach as (
  select vec_id as a, vec_id as b from embeddings
  union
  select reach.a, links.b from reach join links on links.a = reach.b
), component as (
  select a as vec_id, min(b) as component_id from reach group by a
)
select vec_id, (select count(*) from links where links.a = component.vec_id) as n_links,
  component_id, vec_id = component_id as kept
from component
"""


def _op10() -> str:
    rows = ", ".join(
        f"({k}, '{t.label}', {len(t.words)}, {len(t.mandatory)}, {t.base}, {j}, '{w}', {j in t.mandatory})"
        for k, t in enumerate(TEMPLATES)
        for j, w in enumerate(t.words)
    )
    return rf"""
with docs as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), template(id, label, n, must_n, base, place, word, must) as (values {rows}),
hit as (
  select doc_id, i - 1 as pos, w[i] as word from docs, unnest(range(1, len(w) + 1)) r(i)
  where w[i] in (select word from template)
), place as (
  select doc_id, id, label, base, n, pos - place as start, count(*) as standing
  from hit join template using (word)
  group by doc_id, id, label, base, n, must_n, pos - place
  having count(*) filter (where must) = must_n
), found as (
  select doc_id, count(*) filter (where base) as n_base,
    min(start) filter (where base) as first_word, max(start) filter (where base) as last_word,
    string_agg(distinct label, ',' order by label) filter (where base) as base_labels,
    string_agg(distinct label, ',' order by label) as labels, max(standing / n) as score
  from place group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  cast(coalesce(score, 0) as double) as score
from docs left join found using (doc_id)
"""


OP11 = r"""
with docs as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), windows as (
  select r, doc_id, i, array_to_string(w[i : i + 12], ' ') as s
  from docs, unnest(range(1, len(w) - 11)) t(i) where len(w) >= 13
), holder as (
  select s, min(doc_id) as first_id from windows group by s
), gone as (
  select distinct r, i + j as k from windows join holder using (s), unnest(range(0, 13)) u(j) where first_id < doc_id
), places as (
  select r, k, w[k] as word from docs, unnest(range(1, len(w) + 1)) t(k)
), kept as (
  select r, count(*) as n, string_agg(word, ' ' order by k) as words from places anti join gone using (r, k) group by r
)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
  sha256(coalesce(words, '')) as kept_sha256
from docs left join kept using (r)
"""


def _op12(levels: int = 6, top_levels: int = 3) -> str:
    """Levels are written out one by one: sources of up to 16^levels documents, 16^top_levels sources."""
    field = "case when {0} is null then '-' else strlen(cast({0} as varchar)) || ':' || cast({0} as varchar) end"
    text = field.format("text")
    lower = field.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    rest = " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
    steps = [f"""
crc_table as (
  select list(list_reduce(range(0, 8), lambda c, b: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) order by i) as t
  from range(0, 256) g(i)
), leaves as (
  select *, xor(list_reduce([ascii(c) for c in string_split(cast(doc_id as varchar), '')],
      lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1]), 4294967295), 4294967295) as crc,
    sha256({rest} || {text}) as leaf, sha256({rest} || {lower}) as other,
  from documents, crc_table
), t0 as (
  select leaf as digest, source, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i,
    count(*) over (partition by source) as n, doc_id, case when crc % 5 = 0 then other else leaf end as changed
  from leaves
)"""]

    def climb(first: str, name: str, count: int, keys: str) -> None:
        for k in range(count):
            below = first if k == 0 else f"{name}{k}"
            on = f"{keys}, " if keys else ""
            steps.append(f"""{name}{k + 1} as (
  select {on} i // 16 as i, max((n + 15) // 16) as n,
    case when max(n) = 1 then min(digest) else sha256(string_agg(digest, '' order by i)) end as digest,
    case when max(n) = 1 then [] else list(digest order by i) end as run
  from {below} group by {on} i // 16
)""")

    climb("t0", "t", levels, "source")
    steps.append(f"""s0 as (
  select source, digest, row_number() over (order by source nulls first) - 1 as i, count(*) over () as n from t{levels}
)""")
    climb("s0", "s", top_levels, "")
    runs = [f"t{k + 1}.run as r{k}, t0.i // {16 ** k} % 16 as p{k}" for k in range(levels)]
    runs += [f"s{k + 1}.run as r{levels + k}, s0.i // {16 ** k} % 16 as p{levels + k}" for k in range(top_levels)]
    joins = [f"join t{k + 1} on t{k + 1}.source is not distinct from t0.source and t{k + 1}.i = t0.i // {16 ** (k + 1)}" for k in range(levels)]
    joins.append("join s0 on s0.source is not distinct from t0.source")
    joins += [f"join s{k + 1} on s{k + 1}.i = s0.i // {16 ** (k + 1)}" for k in range(top_levels)]
    steps.append(f"""ways as (
  select t0.doc_id, t0.digest as leaf, t0.changed, s0.digest as subroot, s{top_levels}.digest as root, {", ".join(runs)}
  from t0 {" ".join(joins)}
)""")
    sides = " || ".join(
        f"coalesce(array_to_string(list_concat(r{k}[:p{k}], r{k}[p{k} + 2:]), ''), '')" for k in range(levels + top_levels)
    )
    steps.append(f"f0 as (select *, changed as folded0, sha256({sides}) as proof from ways)")
    for k in range(levels + top_levels):
        steps.append(f"""f{k + 1} as (select *, case when len(r{k}) = 0 then folded{k} else
  sha256(array_to_string(list_concat(list_concat(r{k}[:p{k}], [folded{k}]), r{k}[p{k} + 2:]), '')) end as folded{k + 1} from f{k})""")
    last = levels + top_levels
    return f"""with {", ".join(steps)}
select doc_id, leaf, subroot, root, proof as proof_sha256, folded{last} as folded_root, folded{last} = root as verified from f{last}"""


OP13 = r"""
with docs as (
  select doc_id, row_number() over () as r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
), totals as (
  select count(*) filter (where len(w) > 0) as docs, cast(sum(len(w)) as bigint) as terms from docs
), asked as (
  select item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select distinct item_id, text from benchmark)
), postings as (
  select r, term, count(*) as tf from (select r, unnest(w) as term from docs)
  where term in (select term from asked) group by r, term
), weighted as (
  select term, cast(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) as bigint) as weight
  from postings, totals group by term
), impacts as (
  select r, term, weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(w) * docs) // terms))) as impact
  from postings join weighted using (term) join docs using (r), totals
), scores as (
  select item_id, r, cast(sum(impact) as bigint) as score from asked join impacts using (term) group by item_id, r
)
select item_id, cast(rank as integer) as rank, doc_id, score from (
  select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank
  from scores join docs using (r) where score > 0
) where rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_subspace_dedup": OP4,
        "op7_minmax_dedup": OP7,
        "op10_license_scan": _op10(),
        "op11_seed_extend": OP11,
        "op12_postorder_manifest": _op12(),
        "op13_nra_search": OP13,
    }
