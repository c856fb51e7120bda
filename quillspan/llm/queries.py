"""The queries of the problems, over the whole tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspan import fixed_values as V
from quillspan.llm import encoding, groups, overlap, packing, pairs, quota, residue, runs
from quillspan.plans.tables import table
from quillspan.session import cut_lineage

#: white space in the Unicode sense, for character classes of the SQL engine
BLANKS = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# --- 1: the same or nearly the same records across splits ----------------------------------


def _overlaps(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "prefixes").select("sample_id", "split", "messages")
    return overlap.split_overlaps(
        rows,
        "sample_id",
        overlap.spoken_words(F.col("messages")),
        F.col("split") == "train",
        F.col("split").isin("validation", "test"),
    )


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("sample_id_t"), F.col("sample_id_e")
    pairs = _overlaps(spark, d)
    return pairs.select(F.least(a, b).alias("sample_id_a"), F.greatest(a, b).alias("sample_id_b")).distinct()


_OVERLAPS = f"""spoken as (
  select rid, sample_id, split, lower(coalesce(m.content, '')) as said from (
    select rid, sample_id, split, unnest(messages) as m from (
      select row_number() over () as rid, * from (
        select distinct sample_id, split, messages from prefixes where sample_id is not null and split is not null)))
  where lower(trim(coalesce(m.role, ''))) <> 'system'),
words as (select rid, sample_id, split, unnest(regexp_extract_all(said, '[^{BLANKS}]+')) as w from spoken),
counted as (select rid, sample_id, split, w, count(*) as n from words group by all),
sizes as (select rid, sum(n) as n from counted group by rid),
both_ways as (
  select e.rid as e, t.rid as t, e.sample_id as a, t.sample_id as b, sum(least(e.n, t.n)) as common
  from counted e join counted t on e.w = t.w and e.split in ('validation', 'test') and t.split = 'train'
    and e.sample_id <> t.sample_id
  group by all)"""
ORACLE["p1_found"] = f"""with {_OVERLAPS}
select distinct least(a, b) as sample_id_a, greatest(a, b) as sample_id_b
from both_ways join sizes x on x.rid = e join sizes y on y.rid = t
where 5 * common >= 4 * x.n and 5 * common >= 4 * y.n"""


@query
def p1_report(spark: SparkSession, d: str) -> DataFrame:
    """Overlaps per split and source of the evaluation prefix: pairs, and prefixes of each side.

    A source has one row per split however it is written, and is spelled by `quota.spelled`.
    """
    own = table(spark, d, "prefixes").where("split in ('validation', 'test')")
    source = quota.spelled(F.col("source"), V.SOURCES).alias("source")
    own = own.select(F.col("sample_id").alias("sample_id_e"), "split", source).distinct()
    return (
        _overlaps(spark, d)
        .join(own, "sample_id_e")
        .groupBy("split", "source")
        .agg(
            F.count_distinct("sample_id_e", "sample_id_t").alias("n_pairs"),
            F.count_distinct("sample_id_e").alias("n_eval"),
            F.count_distinct("sample_id_t").alias("n_train"),
        )
    )


_SPELLED = "case regexp_replace(lower(source), '[^\\p{L}\\p{N}]', '', 'g') " + " ".join(
    f"when '{''.join(c for c in name if c.isalnum())}' then '{name}'" for name in V.SOURCES
) + " when '' then trim(source) else regexp_replace(lower(source), '[^\\p{L}\\p{N}]', '', 'g') end"
ORACLE["p1_report"] = f"""with {_OVERLAPS},
hits as (
  select distinct a, b from both_ways join sizes x on x.rid = e join sizes y on y.rid = t
  where 5 * common >= 4 * x.n and 5 * common >= 4 * y.n),
own as (select distinct sample_id as a, split, {_SPELLED} as source from prefixes where split in ('validation', 'test'))
select split, source, count(distinct (a, b)) as n_pairs, count(distinct a) as n_eval, count(distinct b) as n_train
from hits join own using (a) group by all"""


# --- 2: splits that keep related records together -----------------------------------------

def _repo_links() -> dict:
    return {"repo": groups.repo_key(F.col("repo")), "instance": groups.instance_key(F.col("instance_id"))}


@query
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "prefixes").select("repo", "instance_id")
    return groups.pairs_of(groups.must_share(rows, "repo", _repo_links()), "repo", "root")


_PATH = (
    f"regexp_replace(regexp_replace(lower(repo), '^[{BLANKS}]+|[{BLANKS}]+$', '', 'g'), "
    "'^(?:[a-z][a-z0-9+.-]*://[^/]+/+|[^/@]+@[^/:]+:/*)', '')"
)
ORACLE["p2_found"] = f"""with recursive path as (
  select distinct repo, nullif(trim(lower(regexp_replace(instance_id, '^[{BLANKS}]+|[{BLANKS}]+$', '', 'g'))), '') as i,
    {_PATH} as p from prefixes),
named as (
  select repo, i, case when p similar to '/*[^/]+(__|/+)[^/]+.*' then
    regexp_extract(p, '^/*([^/]+?)(?:__|/+)', 1) || '/' ||
    regexp_extract(p, '^/*[^/]+?(?:__|/+)([^/]+?)(?:[.]git)?(?:/.*)?$', 1) end as k
  from path),
ties as (
  select repo, 'k' || k as t from named where repo is not null and k is not null
  union select repo, 'i' || i from named where repo is not null and i is not null),
edges as (select distinct a.repo as a, b.repo as b from ties a join ties b using (t)),
reach as (select a, b from edges union select r.a, e.b from reach r join edges e on r.b = e.a)
select a as repo_a, b as repo_b from reach where a < b"""


@query
def p2_splits(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "prefixes").select("sample_id", "repo", "instance_id")
    return groups.grouped_split(rows, "sample_id", _repo_links(), table(spark, d, "split_targets"))


@query
def p2_audit(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of `p2_splits`: every record once, no repository or ticket torn, shares met up to the largest group."""
    rows = table(spark, d, "prefixes").select("sample_id", "repo", "instance_id")
    placed = cut_lineage(p2_splits(spark, d))
    links = groups.linked(rows.where("sample_id is not null"), {"sample": F.col("sample_id"), **_repo_links()})
    torn = (
        links.join(placed.select(F.concat(F.lit("sample="), F.col("sample_id")).alias("a"), "split"), "a")
        .groupBy("b")
        .agg(F.count_distinct("split").alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("n_torn"))
    )
    whole = groups.components(groups.linked(rows, {"sample": F.col("sample_id"), **_repo_links()}))
    largest = whole.where("node like 'sample=%'").groupBy("root").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"))
    once = placed.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("sample_id").alias("n_records")).first()
    sizes = placed.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    off = F.abs(F.coalesce("n", F.lit(0)) - F.col("share") * F.lit(once.n_records)) > F.lit(largest.first().most or 0)
    n_far = table(spark, d, "split_targets").join(sizes, "split", "left").where(off).count()
    row = (once.n_rows, once.n_records, torn.first().n_torn, n_far)
    return spark.createDataFrame([row], "n_rows bigint, n_records bigint, n_torn bigint, n_far bigint")


ORACLE["p2_audit"] = """select count(distinct sample_id) as n_rows, count(distinct sample_id) as n_records,
  0::bigint as n_torn, 0::bigint as n_far from prefixes"""


# --- 3: broken prompt and response pairs ---------------------------------------------------

_PAIR = ["sample_id", "chosen_rollout", "rejected_rollout"]


def _defects(spark: SparkSession, d: str) -> DataFrame:
    return pairs.defective_answers(table(spark, d, "dpo"), _PAIR)


@query
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _defects(spark, d).where("place = 1").drop("place").distinct()


@query
def p3_all_defects(spark: SparkSession, d: str) -> DataFrame:
    return _defects(spark, d).distinct()


# --- 4: repeated consecutive events -------------------------------------------------------

_ROLLOUT = ["sample_id", "rollout"]


def _collapsed(spark: SparkSession, d: str, carry: list[str] = ()) -> DataFrame:
    rows = table(spark, d, "rollouts").select(*_ROLLOUT, "commands", "cmd_ms")
    events = runs.command_events(rows, _ROLLOUT, text=bool(carry))
    events = cut_lineage(events.where("form is not null"))  # commands are parsed once, though bounds are sampled
    return runs.collapse_runs(events, [*_ROLLOUT, "version"], carry=carry)


@query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The runs of `p4_collapsed` that are more than one entry, durations summed there and here."""
    found = _collapsed(spark, d).where("n >= 2")
    return found.select(*_ROLLOUT, "first_pos", "last_pos").distinct()


@query
def p4_collapsed(spark: SparkSession, d: str) -> DataFrame:
    """Every list with its runs as one entry: count, summed duration and the command as first written."""
    found = _collapsed(spark, d, ["command"])
    return found.select(*_ROLLOUT, "first_pos", "last_pos", "n", "total_ms", "command").distinct()


# --- 5: sample matching target proportions ------------------------------------------------

_CELL = ["phase_wanted", "source"]


def _quota(spark: SparkSession, d: str) -> quota.QuotaSample:
    rows = table(spark, d, "prefixes").select("sample_id", *_CELL)
    return quota.quota_sample(rows, table(spark, d, "quota_targets"), "sample_id", _CELL)


@query
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _quota(spark, d).cells.where("deficit > 0").select(*_CELL)


@query
def p5_sample(spark: SparkSession, d: str) -> DataFrame:
    return _quota(spark, d).sample


@query
def p5_cells(spark: SparkSession, d: str) -> DataFrame:
    return _quota(spark, d).cells


@query
def p5_audit(spark: SparkSession, d: str) -> DataFrame:
    """The sample counted by cell, keys of the sample twice in a cell, and keys that are not of their cell."""
    own = _quota(spark, d)
    rows = table(spark, d, "prefixes").select("sample_id", *_CELL)
    known = quota.labelled(rows, table(spark, d, "quota_targets"), "sample_id", _CELL).withColumn("known", F.lit(True))
    marked = own.sample.join(known, ["sample_id", *_CELL], "left")
    return marked.groupBy(*_CELL).agg(
        F.count(F.lit(1)).alias("drawn"),
        (F.count(F.lit(1)) - F.count_distinct("sample_id")).alias("n_twice"),
        F.count_if(F.col("known").isNull()).alias("n_foreign"),
    )


_POOL = r"""pool as (
  select distinct p.sample_id, a.phase_wanted, b.source from prefixes p
  join (select distinct phase_wanted, regexp_replace(lower(phase_wanted), '[^a-z0-9]', '', 'g') as k from quota_targets) a
    on a.k = regexp_replace(lower(p.phase_wanted), '[^a-z0-9]', '', 'g')
  join (select distinct source, regexp_replace(lower(source), '[^a-z0-9]', '', 'g') as k from quota_targets) b
    on b.k = regexp_replace(lower(p.source), '[^a-z0-9]', '', 'g')
  where p.sample_id is not null),
cells as (
  select t.phase_wanted, t.source, greatest(min_rows, cast(ceil(
    cast(share as decimal(18,9)) * (select count(distinct sample_id) from pool) / 5) as bigint)) as target,
    (select count(*) from pool where pool.phase_wanted = t.phase_wanted and pool.source = t.source) as available
  from quota_targets t)"""
ORACLE["p5_found"] = f"with {_POOL} select phase_wanted, source from cells where available < target"
ORACLE["p5_cells"] = f"""with {_POOL} select *, least(target, available) as drawn,
  target - least(target, available) as deficit from cells"""

ORACLE["p5_audit"] = f"""with {_POOL} select phase_wanted, source, least(target, available) as drawn, 0::bigint as n_twice,
  0::bigint as n_foreign from cells where least(target, available) > 0"""


# --- 6: encoding of the corpus ------------------------------------------------------------


@query
def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return encoding.token_ids(table(spark, d, "documents"), "doc_id", "text")


# --- 7: filling containers ----------------------------------------------------------------


@query
def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    sizes = encoding.token_counts(table(spark, d, "documents"), "doc_id", "text")
    return packing.pack(sizes, table(spark, d, "pack_specs"), "doc_id")


@query
def p7_summary(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_summary(p7_containers(spark, d))


@query
def p7_audit(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of `p7_containers` for each capacity.

    Documents that are there, pieces of whole documents, documents whose pieces do not add up,
    containers that are too full or tell a wrong free space, and whether nine tenths are filled.
    """
    sizes = cut_lineage(encoding.token_counts(table(spark, d, "documents"), "doc_id", "text"))
    specs = table(spark, d, "pack_specs").select("spec", "capacity")
    packed = cut_lineage(packing.pack(sizes, specs, "doc_id"))
    end = F.col("start") + F.col("tokens")
    per_doc = packed.groupBy("spec", "doc_id").agg(
        F.sum("tokens").alias("got"), F.max(end).alias("end"), F.count(F.lit(1)).alias("pieces")
    )
    per_doc = per_doc.join(sizes, "doc_id").join(F.broadcast(specs), "spec")
    whole = (F.col("got") == F.col("tokens")) & (F.col("end") == F.col("tokens"))
    whole = whole & (F.col("pieces") == F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.col("capacity"))))
    docs = per_doc.groupBy("spec").agg(F.count(F.lit(1)).alias("n_docs"), F.count_if(~whole).alias("n_broken"))
    bins = packed.groupBy("spec", "container").agg(F.sum("tokens").alias("used"), F.min("free").alias("a"), F.max("free").alias("b"))
    bins = bins.join(F.broadcast(specs), "spec")
    fits = (F.col("used") <= F.col("capacity")) & (F.col("a") == F.col("b")) & (F.col("used") + F.col("a") == F.col("capacity"))
    filled = F.sum("used") >= 0.9 * F.sum("capacity")
    return docs.join(bins.groupBy("spec").agg(F.count_if(~fits).alias("n_wrong"), filled.alias("filled")), "spec")


ORACLE["p7_audit"] = """select spec, (select count(distinct doc_id) from documents) as n_docs, 0::bigint as n_broken,
  0::bigint as n_wrong, true as filled from pack_specs"""


# --- 8: template residue and error pages ---------------------------------------------------


def _documents(spark: SparkSession, d: str) -> DataFrame:
    host = F.coalesce(groups.repo_key(F.col("repo")), F.lit(""))
    return table(spark, d, "documents").withColumn("host", host)


@query
def p8_found(spark: SparkSession, d: str) -> DataFrame:
    rows = _documents(spark, d)
    model = residue.train(rows, "doc_id", "text", "host")
    return residue.find_residue(rows, "doc_id", "text", model).select("doc_id").distinct()


@query
def p8_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = _documents(spark, d)
    model = residue.train(rows, "doc_id", "text", "host")
    found = residue.find_residue(rows, "doc_id", "text", model)
    return found.select("doc_id", "kind", "line", F.round("score", 3).alias("score"))


@query
def p8_clean(spark: SparkSession, d: str) -> DataFrame:
    """The corpus without documents of residue."""
    return table(spark, d, "documents").join(p8_found(spark, d), "doc_id", "left_anti")


@query
def p8_validation(spark: SparkSession, d: str) -> DataFrame:
    """What the classifier reaches on hosts it has not seen."""
    report = residue.validate(_documents(spark, d), "doc_id", "text", "host")
    rows = [(name, float(value)) for name, value in report.items()]
    return spark.createDataFrame(rows, "measure string, value double")
