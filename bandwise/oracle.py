"""The named queries in plain SQL, for checking on DuckDB."""

from __future__ import annotations

from bandwise.functions.simhash import hyperplanes
from bandwise.queries import BS, KS, M, SMALL_KS, WIDE_BS, WIDE_M

EMBEDDING_DIM = 64
NEAR_COPIES = """
    select vec_id * 2 as doc_id, embedding::double[] as vec from embeddings
    union all
    select vec_id * 2 + 1, list_concat(embedding[1:-2]::double[], [embedding[-1]::double / 2]) from embeddings"""
TABLE = "select vec_id as doc_id, embedding::double[] as vec from embeddings"
SIZES = """select count(*) // 4 as n from embeddings union all select count(*) // 2 from embeddings
    union all select count(*) from embeddings"""
MEANS = """round(case when count(d1) = 0 then 0 else avg(cos) end, 6) + 0.0 as mean_cosine,
    round(coalesce(avg(h), 0), 6) + 0.0 as mean_hamming,
    round(coalesce(avg(cos(h * pi() / {m})), 0), 6) + 0.0 as cosine_hamming"""


def ctes(m: int = M, bs: tuple[int, ...] = BS, vectors: str = TABLE) -> str:
    """Planes, vectors, signature bits and band keys as common table expressions."""
    planes = ",\n".join(
        f"({j}, [{', '.join(repr(float(x)) for x in row)}]::double[])"
        for j, row in enumerate(hyperplanes(m, EMBEDDING_DIM))
    )
    layout = ", ".join(f"({b}, {m // b})" for b in bs)
    return f"""with planes(j, plane) as (values {planes}),
vectors as ({vectors}),
bits as (
    select doc_id, j, (list_dot_product(vec, plane) > 0)::int as bit from vectors, planes
),
layout(b, r) as (values {layout}),
bands as (
    select doc_id, b, (j // r)::int as band_idx,
        case when sum(bit::hugeint << (j % r)) >= 9223372036854775808
            then (sum(bit::hugeint << (j % r)) - 18446744073709551616)::bigint
            else sum(bit::hugeint << (j % r))::bigint end as band_val
    from bits, layout where j < b * r group by doc_id, b, r, j // r
)"""


def word(n: int) -> str:
    total = f"sum(case when j // 64 = {n} then bit::hugeint << (j % 64) else 0 end)"
    return f"""case when {total} >= 9223372036854775808 then ({total} - 18446744073709551616)::bigint
        else {total}::bigint end"""


def pairs() -> str:
    return """pairs as (
    select distinct l.b, l.doc_id as d1, r.doc_id as d2
    from bands l join bands r on l.b = r.b and l.band_idx = r.band_idx and l.band_val = r.band_val
        and l.doc_id < r.doc_id
)"""


def scored() -> str:
    """Pairs with Hamming distance and cosine, as relation ``scored``."""
    return """distances as (
    select p.d1, p.d2, sum((x.bit <> y.bit)::int)::int as h
    from (select distinct d1, d2 from pairs) p join bits x on x.doc_id = p.d1
        join bits y on y.doc_id = p.d2 and y.j = x.j
    group by p.d1, p.d2
),
scored as (
    select p.b, p.d1, p.d2, h, list_cosine_similarity(x.vec, y.vec) as cos
    from pairs p join distances using (d1, d2)
        join vectors x on x.doc_id = p.d1 join vectors y on y.doc_id = p.d2
)"""


def quality(
    ks: tuple[int, ...], m: int = M, bs: tuple[int, ...] = BS, vectors: str = TABLE
) -> str:
    values = ", ".join(f"({k})" for k in ks)
    return f"""{ctes(m, bs, vectors)}, {pairs()}, {scored()},
close_pairs as (select b, k, d1, d2, h, cos from scored join (values {values}) t(k) on h <= k),
docs as (
    select b, k, count(distinct doc) as num_docs
    from (select b, k, d1 as doc from close_pairs union all select b, k, d2 from close_pairs) group by b, k
)
select l.b, {m} as m, t.k, coalesce(any_value(num_docs), 0) as num_docs, count(d1) as num_pairs,
    {MEANS.format(m=m)}
from layout l cross join (values {values}) t(k)
    left join close_pairs s on s.b = l.b and s.k = t.k left join docs d on d.b = l.b and d.k = t.k
group by l.b, t.k"""


def sweep_table(m: int, bs: tuple[int, ...], ks: tuple[int, ...], vectors: str = TABLE) -> str:
    """One query per size would repeat the planes, so the size joins as a column instead."""
    values = ", ".join(f"({k})" for k in ks)
    return f"""{ctes(m, bs, vectors)},
sizes as ({SIZES}),
places as (select doc_id, row_number() over (order by doc_id) as place from vectors),
kept as (select n, bands.* from bands join places using (doc_id) join sizes on place <= n),
sized as (
    select distinct l.n, l.b, l.doc_id as d1, r.doc_id as d2
    from kept l join kept r on l.n = r.n and l.b = r.b and l.band_idx = r.band_idx
        and l.band_val = r.band_val and l.doc_id < r.doc_id
),
pairs as (select distinct b, d1, d2 from sized),
{scored()},
close_pairs as (
    select n, b, k, d1, d2, h, cos from sized join scored using (b, d1, d2)
        join (values {values}) t(k) on h <= k
),
docs as (
    select n, b, k, count(distinct doc) as num_docs
    from (select n, b, k, d1 as doc from close_pairs union all select n, b, k, d2 from close_pairs) group by n, b, k
)
select i.n::bigint as n, l.b, {m} as m, t.k, coalesce(any_value(num_docs), 0) as num_docs, count(d1) as num_pairs,
    {MEANS.format(m=m)}
from sizes i cross join layout l cross join (values {values}) t(k)
    left join close_pairs s on s.n = i.n and s.b = l.b and s.k = t.k
    left join docs d on d.n = i.n and d.b = l.b and d.k = t.k
group by i.n, l.b, t.k"""


def sweep(
    ms: tuple[int, ...] = (M,),
    bs: tuple[int, ...] = BS,
    ks: tuple[int, ...] = KS,
    vectors: str = TABLE,
) -> str:
    return " union all ".join(f"select * from ({sweep_table(m, bs, ks, vectors)})" for m in ms)


def growth() -> str:
    return f"select n, b, num_pairs from ({sweep(bs=(8, 16))}) where k = {KS[len(KS) // 2]}"


def candidate_count(m: int = M, bs: tuple[int, ...] = BS) -> str:
    return f"""{ctes(m, bs)}, {pairs()}
select layout.b, count(d1) as candidates from layout left join pairs using (b) group by layout.b"""


def similar_pairs(k: int | None, vectors: str = TABLE) -> str:
    test = "" if k is None else f" where h <= {k}"
    return f"""{ctes(vectors=vectors)}, {pairs()}, {scored()}
select b, d1, d2, h, round(cos, 6) + 0.0 as cos from scored{test}"""


def oracle_sql() -> dict[str, str]:
    return {
        "vector_prefix": """select vec_id as doc_id, len(embedding)::int as dim,
    list_min(embedding)::double as vec_min, list_max(embedding)::double as vec_max
from embeddings where vec_id < (select count(*) // 2 from embeddings)""",
        "vector_norm": """select vec_id as doc_id,
    round(sqrt(list_dot_product(embedding::double[], embedding::double[])), 6) + 0.0 as norm from embeddings""",
        "simhash_signature": f"{ctes()} select doc_id, {word(0)} as sig from bits group by doc_id",
        "simhash_signature_wide": f"""{ctes(WIDE_M)}
select doc_id, {word(0)} as word0, {word(1)} as word1 from bits group by doc_id""",
        "band_keys": f"{ctes()} select doc_id, b, band_idx, band_val from bands",
        "band_keys_wide": f"{ctes(WIDE_M, WIDE_BS)} select doc_id, b, band_idx, band_val from bands",
        "bucket_sizes": f"""{ctes()}
select b, band_idx, band_val, count(*) as bucket_size from bands group by b, band_idx, band_val""",
        "candidate_pairs": f"{ctes()}, {pairs()} select b, d1, d2 from pairs",
        "candidate_count": candidate_count(),
        "candidate_count_wide": candidate_count(WIDE_M, WIDE_BS),
        "hamming_pairs": f"{ctes()}, {pairs()}, {scored()} select b, d1, d2, h from scored",
        "cosine_pairs": similar_pairs(None),
        "similar_pairs_k16": similar_pairs(16),
        "similar_pairs_k24": similar_pairs(24),
        "similar_docs_by_k": f"select b, k, num_docs from ({quality(KS)})",
        "quality_by_k": quality(KS),
        "quality_by_k_wide": quality((32, 40, 48), m=WIDE_M, bs=WIDE_BS),
        "quality_by_k_empty": quality((0,)),
        "near_duplicates": similar_pairs(max(SMALL_KS), NEAR_COPIES),
        "near_duplicate_quality": quality(SMALL_KS, vectors=NEAR_COPIES),
        "sweep_quality": sweep(),
        "sweep_sparse_ids": sweep(vectors="select vec_id * 1000003 - 250000000 as doc_id, embedding::double[] as vec from embeddings"),
        "sweep_signature_bits": sweep(ms=(32, 64, 128, 256), bs=(8,), ks=(12, 20, 44)),
        "sweep_largest_n": f"with s as ({sweep()}) select * from s where n = (select max(n) from s)",
        "sweep_representative_k": f"select * from ({sweep()}) where k = {KS[len(KS) // 2]}",
        "scaling_exponent": f"""select b, round(regr_slope(ln(num_pairs), ln(n)), 6) + 0.0 as exponent
from ({growth()}) where num_pairs > 0 group by b""",
        "growth_curves": f"""with g as ({growth()}),
start as (select min(n) as n0, min(num_pairs)::double as v0 from g)
select distinct n, round(v0 * n / n0, 6) + 0.0 as linear, round(v0 * n / n0 * n / n0, 6) + 0.0 as quadratic
from g, start""",
        "fvecs_round_trip": """select row_number() over (order by vec_id) - 1 as doc_id, len(embedding)::int as dim,
    embedding[1]::double as vec_first, embedding[-1]::double as vec_last,
    round(list_sum(embedding::double[]), 6) + 0.0 as vec_sum from embeddings""",
        "quality_table_round_trip": sweep(),
        "scored_pairs_round_trip": similar_pairs(16),
    }
