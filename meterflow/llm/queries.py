"""The queries of this subpackage, with production parameters, and SQL for those SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterflow.llm import byte_bpe, dart_minhash, decontaminate, frames, grace, importance, license_scan, merkle, quality_rules, secret_scan, token_counts, toxicity, warc
from meterflow.llm.ship import ship_package
from meterflow.plans.stage import new_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_pages(table(spark, sf_dir, "pages"), path)
    return warc.page_records(warc.read_archives(spark, path, "part-*"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.duplicate_classes(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), *vocabulary())


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return license_scan.digest(license_scan.scan(docs, license_scan.train(docs)))


def op9_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), *vocabulary())


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.fill_in_middle(frames.store(table(spark, sf_dir, "documents")), outputs=False)


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grace.duplicate_groups(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc, op2_quality_rules, op3_near_duplicates, op4_toxicity, op5_secrets,
        op6_decontaminate, op7_byte_bpe, op8_licenses, op9_importance, op10_token_counts,
        op11_merkle_manifest, op12_fill_in_middle, op13_exact_dedup,
    )
}



def _merkle_sql(depth: int = 6, depth_of_sources: int = 3) -> str:
    """SQL of op11 for at most 16^depth documents in a source and 16^depth_of_sources sources: level by
    level the runs of 16 nodes, and the documents' proofs and folded nodes along them."""
    field = "case when {0} is null then '-' else concat(strlen(cast({0} as varchar)), ':', {0}) end".format
    leaf = lambda text: f"sha256(concat({field('doc_id')}, {field('source')}, {field('lang')}, {field('n_chars')}, {field(text)}))"
    parts = [
        f"""table_ as (select list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t from range(256) r(i)),
        d as (select *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_, cast(doc_id as varchar) as digits from documents),
        e as (select *, xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(string_split(digits, ''), lambda c: cast(ascii(c) as bigint))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 5 = 0 as hit from d, table_),
        l as (select doc_id, source, {leaf('text')} as leaf, case when hit then {leaf('lower_')} else {leaf('text')} end as claim from e),
        p0 as (select doc_id, dense_rank() over (order by source nulls first) - 1 as s, row_number() over (partition by source order by doc_id nulls first) - 1 as i, count(*) over (partition by source) as n, leaf, claim as folded, '' as proof from l),
        n0 as (select s, i, n, leaf as h from p0)"""
    ]
    for k in range(1, depth + depth_of_sources + 1):
        if k == depth + 1:  # from here the sources are the leaves of one tree
            parts.append(f"m as (select 0 as s, s as i, count(*) over () as n, h from n{k - 1}), q as (select doc_id, 0 as s, s as i, (select count(*) from m) as n, leaf, folded, proof, (select any_value(h) from m where m.i = p.s) as subroot from p{k - 1} p)")
        nodes, path = ("m", "q") if k == depth + 1 else (f"n{k - 1}", f"p{k - 1}")
        more = ", subroot" if k > depth else ""
        parts.append(f"r{k} as (select s, i // 16 as g, list(h order by i) as hs from {nodes} where n > 1 group by s, g)")
        parts.append(f"n{k} as (select s, i // 16 as i, (any_value(n) + 15) // 16 as n, sha256(string_agg(h, '' order by i)) as h from {nodes} where n > 1 group by s, i // 16 union all select s, i, n, h from {nodes} where n = 1)")
        side = "coalesce(array_to_string({}, ''), '')".format
        parts.append(
            f"x{k} as (select p.*, {side('hs[1 : i % 16]')} as a, {side('hs[i % 16 + 2 : 16]')} as b from {path} p left join r{k} r on r.s = p.s and r.g = p.i // 16),"
            f" p{k} as (select doc_id, s, i // 16 as i, (n + 15) // 16 as n, leaf, case when n > 1 then sha256(concat(a, folded, b)) else folded end as folded, concat(proof, a, b) as proof{more} from x{k})"
        )
    k = depth + depth_of_sources
    return f"with {', '.join(parts)} select doc_id, leaf, subroot, h as root, sha256(proof) as proof_sha256, folded as folded_root, folded = h as verified from p{k}, n{k}"


#: DuckDB SQL. The others depend on learned models, hashed signatures, token ids or entropy windows;
#: tests/llm holds them against brute force, a library or held-out rows.
ORACLES = {
    "op1_warc": """
        with p as (
            select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as n,
                   sha256(coalesce(html, '')) as digest
            from pages
        ), o as (
            select *, min(page_id) over (partition by digest) as origin from p
        )
        select page_id, cast(n as bigint) as payload_bytes, digest as payload_digest,
               case when n >= 100 and page_id <> origin then 'revisit' else 'response' end as record_type,
               case when n >= 100 and page_id <> origin then origin end as refers_to
        from o
    """,
    "op6_decontaminate": """
        with d as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from documents
        ), b as (
            select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from benchmark
        ), starts as (
            select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0
        ), windows as (
            select distinct item_id, w[i : i + 9] as win, len(w[i : i + 9]) as n from starts
        ), sizes as (
            select distinct n from windows
        ), places as (
            select d.doc_id, s.n, d.w, unnest(range(1, len(d.w) - s.n + 2)) as i from d, sizes s where len(d.w) >= s.n
        ), hits as (
            select p.doc_id, p.i, p.n, x.item_id from places p join windows x on x.n = p.n and x.win = p.w[p.i : p.i + p.n - 1]
        ), words as (
            select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(i, i + n)) as k from hits) group by doc_id
        ), named as (
            select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
            from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id
        )
        select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
               cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from d left join words using (doc_id) left join named using (doc_id)
    """,
    "op11_merkle_manifest": _merkle_sql(),
    "op12_fill_in_middle": """
        with d as (
            select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as w,
                   sha256(concat('1:', coalesce(cast(doc_id as varchar), ''))) as h
            from documents
        ), c as (
            select *, len(w) as n, cast(concat('0x', h[1:8]) as bigint) % (len(w) + 1) as c1, cast(concat('0x', h[9:16]) as bigint) % (len(w) + 1) as c2,
                   cast(concat('0x', h[17:24]) as bigint) % 100 as c3, cast(concat('0x', h[25:32]) as bigint) % 100 as c4
            from d
        ), p as (
            select doc_id, text, n, coalesce(array_to_string(w[1 : least(c1, c2)], ''), '') as prefix,
                   coalesce(array_to_string(w[least(c1, c2) + 1 : greatest(c1, c2)], ''), '') as middle,
                   coalesce(array_to_string(w[greatest(c1, c2) + 1 : n], ''), '') as suffix,
                   case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or c3 >= 90 then 'plain'
                        when c4 < 20 then 'spm' else 'psm' end as form
            from c
        )
        select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
               case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
               sha256(case form when 'plain' then text when 'psm' then concat('<P>', prefix, '<S>', suffix, '<M>', middle)
                      else concat('<S>', suffix, '<P>', prefix, '<M>', middle) end) as output_sha256,
               sha256(text) as restored_sha256
        from p
    """,
    "op13_exact_dedup": """
        with d as (
            select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
        )
        select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size, doc_id = max(doc_id) over g as kept, sha256(t) as text_sha256
        from d window g as (partition by t)
    """,
}
