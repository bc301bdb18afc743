"""Registered queries: metadata, pseudonymisation, checks, sinks, keys and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellstar.functions.clean import measurement_name
from cellstar.operators import checks as K
from cellstar.operators import dims as D
from cellstar.operators import metadata as META
from cellstar.operators import pseudonym as P
from cellstar.operators.keys import stage
from cellstar.operators.lookup import Lookup, broadcast_if_small, resolve_keys
from cellstar.plans.catalog import ORACLES, memo, readings_for, register, star_for
from cellstar.plans.oracle import MEASURES, star_sql
from cellstar.plans.registry_ingest import _LANDING, read_bronze
from cellstar.session import scratch_dir
from cellstar.sinks import publish as PUB
from cellstar.sinks import versions as V
from cellstar.sources import dat as DAT
from cellstar.sources import files as FL
from cellstar.sources import fixtures as fx

LOAD_TIME = "2024-02-01 00:00:00"          # fixed load time of the fixture documents
SALT = "cellstar-fixture-salt"             # pseudonym salt of the fixture run

# --- metadata documents ---------------------------------------------------------------

def _docs(spark, sf_dir, batch=1):
    rows = fx.metadata_rows(fx.readings(spark, sf_dir), batch=batch)
    return META.documents(rows, F.lit(LOAD_TIME).cast("timestamp_ntz"))


def stored_documents(spark, sf_dir):
    path = memo("documents", spark, sf_dir,
                lambda: META.write_documents(_docs(spark, sf_dir), scratch_dir(spark, "documents")))
    return META.read_documents(spark, path)


def upserted_documents(spark, sf_dir):
    new = _docs(spark, sf_dir, batch=2)
    incoming = new.filter(F.substring_index("_id", "_", 1).cast("bigint") % 10 == 0) \
        .unionByName(new.filter(F.substring_index("_id", "_", 1).cast("bigint") % 10 == 5))
    return META.upsert(stored_documents(spark, sf_dir), incoming)


_META_FIELDS = ", ".join(META.DOC_FIELDS)


@register("metadata_json", star_sql(
    "select json_name, cast(to_json(struct_pack(" + ", ".join(f"{c} := {c}" for c in META.DOC_FIELDS)
    + ")) as varchar) as json from meta"))
def metadata_json(spark, sf_dir):
    """B2: JSON text per document, store fields left out."""
    return META.to_json_documents(_docs(spark, sf_dir))


@register("metadata_documents", star_sql(
    f"select json_name as _id, {_META_FIELDS}, json_name || '.json' as filename, "
    f"timestamp '{LOAD_TIME}' as created_at from meta"))
def metadata_documents(spark, sf_dir):
    """A10: the stored collection scanned with its schema."""
    return stored_documents(spark, sf_dir)


_UPSERT_SQL = ("select json_name as _id, operator_name, case when cast(measurement_name as bigint) % 10 = 0 "
               "then 'high' else operator_level end as operator_level, machine_name, machine_type, "
               "electrode_material, measurement_name, json_name || '.json' as filename, "
               f"timestamp '{LOAD_TIME}' as created_at from meta")


@register("document_upsert", star_sql(_UPSERT_SQL))
def document_upsert(spark, sf_dir):
    """Re-delivered documents replace stored ones by key."""
    return upserted_documents(spark, sf_dir)


@register("metadata_by_measurement", star_sql(
    f"select {', '.join(META.DOC_FIELDS)} from ({_UPSERT_SQL})"))
def metadata_by_measurement(spark, sf_dir):
    """Documents written in machine / measurement folders and read back."""
    path = scratch_dir(spark, "metadata-by-measurement")
    docs = META.by_measurement(upserted_documents(spark, sf_dir))
    docs.write.mode("errorifexists").partitionBy("machine_name", "measurement_name").parquet(path)
    schema = docs.select(*[c for c in META.DOC_FIELDS if c not in ("machine_name", "measurement_name")],
                         "machine_name", "measurement_name").schema
    return spark.read.schema(schema).parquet(path).select(*META.DOC_FIELDS)


@register("metadata_enrich", star_sql("""
select s.measurement_name, coalesce(m.operator_name, 'Operator_2d226185_e3f33b7d') as operator_name,
  coalesce(m.operator_level, 'medium') as operator_level, coalesce(m.electrode_material, '1') as electrode_material,
  count(*) as n_readings
from s1c s left join (select * from meta where cast(measurement_name as bigint) % 10 <> 4) m
  on s.measurement_name = m.measurement_name
group by 1, 2, 3, 4"""))
def metadata_enrich(spark, sf_dir):
    """Machine 1 readings get operator, level and material from the
    documents; measurements without a document keep the fixed defaults."""
    from cellstar.plans.star import (DEFAULT_OPERATOR_LEVEL, MACHINE1_DEFAULT_MATERIAL,
                                     MACHINE1_DEFAULT_OPERATOR, clean_sheet)
    rd = fx.readings(spark, sf_dir)
    docs = fx.metadata_rows(rd).filter(F.col("measurement_name").cast("bigint") % 10 != 4)
    rows = META.enrich(clean_sheet(fx.sheet_rows(rd)), docs, {
        "operator_name": MACHINE1_DEFAULT_OPERATOR, "operator_level": DEFAULT_OPERATOR_LEVEL,
        "electrode_material": MACHINE1_DEFAULT_MATERIAL})
    return (rows.groupBy("measurement_name", "operator_name", "operator_level", "electrode_material")
            .agg(F.count(F.lit(1)).alias("n_readings")))


# --- pseudonymisation --------------------------------------------------------------------

def raw_texts(spark, sf_dir):
    """Machine 2 files as they come from the lab: real operator names
    (``Tech <letter>``), read back as whole texts."""
    def build():
        dat = fx.dat_rows(fx.readings(spark, sf_dir))
        real = F.concat(F.lit("Tech "), F.expr("chr(65 + cast(substring_index(operator, '_', -1) as int))"))
        return DAT.write_dat_files(DAT.dat_lines(dat.withColumn("operator", real)), scratch_dir(spark, "raw-dat"))
    files = DAT.read_dat_files(spark, memo("raw-dat", spark, sf_dir, build))
    return files.select("file_stem", F.decode("content", DAT.ENCODING).alias("text"))


def _pseudonymized(spark, sf_dir):
    texts = raw_texts(spark, sf_dir)
    keys = P.key_table(P.operator_names(texts), SALT)
    return P.replace_operators(texts, salt=SALT), keys


_PSEUDO_SQL = f"""
, raw_ops as (
  select distinct split_part(table_name, '_', 1) || '_' || strftime(timestamp, '%Y%m') as file_stem,
    'Tech ' || chr(65 + cast(split_part(operator, '_', 2) as int)) as original from dat)
"""


@register("pseudonymize", star_sql(_PSEUDO_SQL + f"""
select file_stem, original, 'Operator_' || sha256('{SALT}' || original) as pseudonym,
  false as original_left from raw_ops"""))
def pseudonymize(spark, sf_dir):
    """M-1/C18: operator names replaced in whole file texts through a key table."""
    out, _ = _pseudonymized(spark, sf_dir)
    # the i-th operator line before and after replacement, paired on the same row
    pairs = F.arrays_zip(F.regexp_extract_all("text", F.lit(P.OPERATOR_LINE), 1).alias("o"),
                         F.regexp_extract_all("pseudonymized", F.lit(P.OPERATOR_LINE), 1).alias("p"))
    rows = out.select("file_stem", "pseudonymized", F.explode(pairs).alias("pair"))
    return (rows.select("file_stem", F.btrim("pair.o", F.lit(" \t")).alias("original"),
                        F.btrim("pair.p", F.lit(" \t")).alias("pseudonym"), "pseudonymized")
            .select("file_stem", "original", "pseudonym",
                    F.col("pseudonymized").contains(F.concat(F.lit("Operator:\t"), F.col("original")))
                    .alias("original_left"))
            .distinct())


@register("pseudonymize_summary", star_sql(_PSEUDO_SQL + """
select count(distinct file_stem) as n_files, count(distinct file_stem) as n_dat_files,
  count(distinct original) as n_operators from raw_ops"""))
def pseudonymize_summary(spark, sf_dir):
    """F8: files processed and operators pseudonymised."""
    out, _ = _pseudonymized(spark, sf_dir)
    names = F.regexp_extract_all(F.col("text"), F.lit(P.OPERATOR_LINE), 1)
    per_name = out.select("file_stem", (F.col("pseudonymized") != F.col("text")).alias("changed"),
                          F.explode_outer(names).alias("original"))
    return per_name.agg(
        F.count_distinct("file_stem").alias("n_files"),
        F.count_distinct(F.when(F.col("changed"), F.col("file_stem"))).alias("n_dat_files"),
        F.count_distinct(F.btrim("original", F.lit(" \t"))).alias("n_operators"))


@register("reidentify", star_sql(_PSEUDO_SQL + f"""
select file_stem, 'Operator_' || sha256('{SALT}' || original) as pseudonym, original
from raw_ops"""))
def reidentify(spark, sf_dir):
    """M-3: pseudonymised files back to the original names with the key table."""
    out, keys = _pseudonymized(spark, sf_dir)
    seen = P.operator_names(out.select("file_stem", F.col("pseudonymized").alias("text")))
    return (seen.withColumnRenamed("original", "pseudonym").join(keys, "pseudonym", "left")
            .select("file_stem", "pseudonym", "original"))


@register("file_key_table", star_sql(_LANDING + f"""
select regexp_extract(path, '([^/]+)$', 1) as original_filename,
  cast(cast(case ext when '.xlsx' then 1001 else 2001 end
       + row_number() over (partition by ext order by regexp_extract(path, '([^/]+)$', 1), path) - 1 as bigint)
       as varchar) || ext as anonymized_filename,
  '{LOAD_TIME}' as date_anonymized
from (select path, lower(regexp_extract(path, '[^/]*?(\\.[^./]*)$', 1)) as ext from landing)
where ext in ('.xlsx', '.dat')"""))
def file_key_table(spark, sf_dir):
    """M-2: original name -> artificial name and date."""
    seq = FL.file_sequence(FL.landing_paths(fx.readings(spark, sf_dir)))
    return P.file_key_table(seq, LOAD_TIME)


# --- checks (K1-K6) -----------------------------------------------------------------------

UNIQUE_KEYS = {
    "dim_machine": [["machine_id"], ["machine_name"]],
    "dim_measurement": [["measurement_id"], ["measurement_name"]],
    "dim_date": [["date_id"], ["date"]],
    "dim_time": [["time_id"], ["time"]],
    "dim_operator": [["operator_id"], ["operator_name"]],
    "dim_electrode_material": [["electrode_material_id"], ["electrode_material"]],
    "dim_dat_metadata": [["dat_metadata_id"]],
    "fact_excel_measurements": [["fact_excel_measurement_id"]],
    "fact_dat_measurements": [["fact_dat_measurement_id"]],
}
NOT_NULL = {
    "fact_excel_measurements": ["fact_excel_measurement_id", "machine_id", "measurement_id", "timestamp",
                                "date_id", "time_id", "electrode_material_id", "time_in_step", "record_id",
                                "cycle", "step_id", "step_name", "operator_id"],
    "fact_dat_measurements": ["fact_dat_measurement_id", "machine_id", "measurement_id", "timestamp",
                              "date_id", "time_id", "electrode_material_id"],
    "dim_machine": ["machine_id", "machine_name", "machine_type"],
    "dim_measurement": ["measurement_id", "measurement_name"],
    "dim_date": ["date_id", "date", "day", "month", "year"],
    "dim_time": ["time_id", "time", "hour", "minute", "second"],
    "dim_operator": ["operator_id", "operator_name", "operator_level"],
    "dim_electrode_material": ["electrode_material_id", "electrode_material"],
    "dim_dat_metadata": ["dat_metadata_id"],
}
_DIMS = [("machine_id", "dim_machine"), ("measurement_id", "dim_measurement"), ("date_id", "dim_date"),
         ("time_id", "dim_time"), ("electrode_material_id", "dim_electrode_material"),
         ("operator_id", "dim_operator")]
FOREIGN_KEYS = ([("fact_excel_measurements", c, d, c) for c, d in _DIMS]
                + [("fact_dat_measurements", c, d, c) for c, d in _DIMS]
                + [("fact_dat_measurements", "dat_metadata_id", "dim_dat_metadata", "dat_metadata_id")])
# Declared text lengths of the typed schema.
LENGTHS = {
    "dim_machine": {"machine_name": 100, "machine_type": 50},
    "dim_measurement": {"measurement_name": 100},
    "dim_operator": {"operator_name": 100, "operator_level": 50},
    "dim_electrode_material": {"electrode_material": 100},
    "dim_dat_metadata": {"diaphragm": 100, "electrolyte": 100, "electrodes": 100,
                         "current_density_mode": 50, "pump_speed_mode": 50},
    "fact_excel_measurements": {"step_name": 50},
}
# Declared decimal types of the typed schema, per source column.
DECIMAL_TARGETS = {
    "dat": [(MEASURES, 10, 4), (["electrodes_area"], 10, 3),
            (["current_density_value", "pump_speed_value", "experiment_running_time"], 10, 2)],
    "sheet": [(["voltage_V", "current_mA"], 10, 4), (["time_in_step", "capacity_mAh", "energy_mWh"], 18, 8)],
}


def _tables(spark, sf_dir):
    return star_for(spark, sf_dir).tables()


@register("check_unique", star_sql(" union all ".join(
    f"select '{t}' as table_name, '{','.join(cols)}' as key_columns, cast(sum(c) as bigint) as n_rows, "
    f"count(*) as n_keys, cast(count_if(c > 1) as bigint) as n_duplicate_keys "
    f"from (select {', '.join(cols)}, count(*) as c from {t} group by all)"
    for t, sets in UNIQUE_KEYS.items() for cols in sets)))
def check_unique(spark, sf_dir):
    return K.check_unique(_tables(spark, sf_dir), UNIQUE_KEYS)


@register("check_not_null", star_sql(" union all ".join(
    f"select '{t}' as table_name, '{c}' as column_name, cast(count_if({c} is null) as bigint) as n_null from {t}"
    for t, cols in NOT_NULL.items() for c in cols)))
def check_not_null(spark, sf_dir):
    return K.check_not_null(_tables(spark, sf_dir), NOT_NULL)


@register("check_foreign_keys", star_sql(" union all ".join(
    f"select '{f}' as table_name, '{c}' as column_name, '{d}' as referenced_table, count(*) as n_missing "
    f"from {f} x where x.{c} is not null and not exists (select 1 from {d} y where y.{dc} = x.{c})"
    for f, c, d, dc in FOREIGN_KEYS)))
def check_foreign_keys(spark, sf_dir):
    return K.check_foreign_keys(_tables(spark, sf_dir), FOREIGN_KEYS)


@register("check_dense_keys", star_sql(" union all ".join(
    f"select '{t}' as table_name, '{k}' as key_column, cast(sum(c) as bigint) as n_rows, count(*) as n_keys, "
    f"cast(count_if(c > 1) as bigint) as n_duplicate_keys, max({k}) as max_key, "
    f"max({k}) - cast(count_if({k} >= 1) as bigint) as n_missing from (select {k}, count(*) as c from {t} group by 1)"
    for t, k in ((t, sets[0][0]) for t, sets in UNIQUE_KEYS.items()))))
def check_dense_keys(spark, sf_dir):
    """K1: the number keys of the nine tables by bitmaps, keys left out as well."""
    return K.check_dense_keys(_tables(spark, sf_dir), {t: sets[0][0] for t, sets in UNIQUE_KEYS.items()})


@register("check_references", star_sql(" union all ".join(
    f"select '{f}' as table_name, '{c}' as column_name, '{d}' as referenced_table, count(*) as n_missing "
    f"from {f} x where x.{c} is not null and not exists (select 1 from {d} y where y.{dc} = x.{c})"
    for f, c, d, dc in FOREIGN_KEYS)))
def check_references(spark, sf_dir):
    """K4: all references of both facts in one shuffle of their distinct keys."""
    return K.check_references(_tables(spark, sf_dir), FOREIGN_KEYS)


@register("check_lengths", star_sql(" union all ".join(
    f"select '{t}' as table_name, '{c}' as column_name, {n} as \"limit\", "
    f"cast(max(length({c})) as bigint) as max_length, cast(count_if(length({c}) > {n}) as bigint) as n_over "
    f"from {t}"
    for t, cols in LENGTHS.items() for c, n in cols.items())))
def check_lengths(spark, sf_dir):
    return K.check_lengths(_tables(spark, sf_dir), LENGTHS)


@register("check_decimal_range", star_sql(" union all ".join(
    f"select '{t}' as source, '{c}' as column_name, 'decimal({p},{s})' as target, "
    f"cast(count_if({c} is not null and cast({c} as varchar) <> 'NAN' "
    f"and try_cast(cast({c} as varchar) as decimal({p},{s})) is null) as bigint) as n_out_of_range from {t}"
    for t, targets in DECIMAL_TARGETS.items() for cols, p, s in targets for c in cols)))
def check_decimal_range(spark, sf_dir):
    """K6: both machines' values against every declared decimal type."""
    rd = fx.readings(spark, sf_dir)
    parts = [K.check_decimal_range(rows, cols, [(p, s)]).select(F.lit(t).alias("source"), "*")
             for t, rows in (("dat", fx.dat_rows(rd)), ("sheet", fx.sheet_rows(rd)))
             for cols, p, s in DECIMAL_TARGETS[t]]
    from functools import reduce
    return reduce(lambda a, b: a.unionByName(b), parts)


# --- keys --------------------------------------------------------------------------------------

_DIM_KEYS = [("dim_machine", "machine_id", "machine_name"), ("dim_measurement", "measurement_id", "measurement_name"),
             ("dim_date", "date_id", "date"), ("dim_time", "time_id", "time"),
             ("dim_operator", "operator_id", "operator_name"),
             ("dim_electrode_material", "electrode_material_id", "electrode_material"),
             ("dim_dat_metadata", "dat_metadata_id", None)]


@register("next_key", star_sql(" union all ".join(
    f"select '{t}' as table_name, coalesce(max({k}), 0) + 1 as next_key from {t}" for t, k, _ in _DIM_KEYS)))
def next_key(spark, sf_dir):
    """The next free key of each dimension."""
    from functools import reduce
    st = _tables(spark, sf_dir)
    parts = [st[t].agg((F.coalesce(F.max(k), F.lit(0)) + 1).alias("next_key"))
             .select(F.lit(t).alias("table_name"), "next_key") for t, k, _ in _DIM_KEYS]
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("fact_key", star_sql(" union all ".join(
    f"select '{t}' as table_name, count(*) as n_rows, min({k}) as min_key, max({k}) as max_key, "
    f"count(distinct {k}) as n_keys from {t}"
    for t, k in [("fact_excel_measurements", "fact_excel_measurement_id"),
                 ("fact_dat_measurements", "fact_dat_measurement_id")])))
def fact_key(spark, sf_dir):
    """Fact keys are 1..n without gaps or repeats."""
    st = _tables(spark, sf_dir)
    parts = [st[t].agg(F.count(F.lit(1)).alias("n_rows"), F.min(k).alias("min_key"), F.max(k).alias("max_key"),
                       F.count_distinct(k).alias("n_keys")).select(F.lit(t).alias("table_name"), "*")
             for t, k in [("fact_excel_measurements", "fact_excel_measurement_id"),
                          ("fact_dat_measurements", "fact_dat_measurement_id")]]
    return parts[0].unionByName(parts[1])


@register("dim_incremental", star_sql(" union all ".join(
    f"select '{t}' as dimension, {k} as key, cast({nk} as varchar) as natural_key from {t}"
    for t, k, nk in _DIM_KEYS if nk)))
def dim_incremental(spark, sf_dir):
    """E5/G1: load machine 1, then machine 2 against the existing dimensions;
    keys continue after the maximum and equal the one-pass build."""
    from functools import reduce
    st = star_for(spark, sf_dir)
    s1, s2 = st.silver_excel, st.silver_dat
    members = {
        "dim_machine": lambda r: r.select("machine_name", F.col("machine_name").alias("machine_type")),
        "dim_measurement": D.measurement_members, "dim_date": D.date_members, "dim_time": D.time_members,
        "dim_operator": D.operator_members, "dim_electrode_material": D.material_members,
    }
    from cellstar.plans.concurrent import run_concurrently

    def two_loads(t, k, nk):
        first = D.build_dimension(members[t](s1), [nk], k, name=f"{t}-m1")
        both = D.build_dimension(members[t](s2), [nk], k, existing=first, name=f"{t}-m2")
        return both.select(F.lit(t).alias("dimension"), F.col(k).alias("key"),
                           F.col(nk).cast("string").alias("natural_key"))

    built = run_concurrently({t: (lambda t=t, k=k, nk=nk: two_loads(t, k, nk)) for t, k, nk in _DIM_KEYS if nk})
    return reduce(lambda a, b: a.unionByName(b), built.values())


# --- joins ---------------------------------------------------------------------------------------


@register("lookup_left", star_sql("""
select s.operator_name, o.operator_id, count(*) as n_rows
from s2c s left join (select * from dim_operator where operator_name <> 'Operator_6') o
  on s.operator_name = o.operator_name
group by 1, 2"""))
def lookup_left(spark, sf_dir):
    """Optional lookup -- operators missing from the dimension give NULL, the row stays."""
    st = star_for(spark, sf_dir)
    dim = st.dim_operator.filter(F.col("operator_name") != "Operator_6")
    f = resolve_keys(st.silver_dat, [Lookup(dim, "operator_id", ["operator_name"], mode="optional")])
    return f.groupBy("operator_name", "operator_id").agg(F.count(F.lit(1)).alias("n_rows"))


@register("lookup_first", star_sql("""
select s.electrode_material, md.dat_metadata_id, count(*) as n_rows
from s2c s left join (select electrodes, min(dat_metadata_id) as dat_metadata_id from dim_dat_metadata group by 1) md
  on s.electrode_material = md.electrodes
group by 1, 2"""))
def lookup_first(spark, sf_dir):
    """Metadata id found by electrodes only; the lowest id wins (parity mode)."""
    st = star_for(spark, sf_dir)
    f = resolve_keys(st.silver_dat, [Lookup(st.dim_dat_metadata, "dat_metadata_id", ["electrode_material"],
                                            ["electrodes"], mode="first")])
    return f.groupBy("electrode_material", "dat_metadata_id").agg(F.count(F.lit(1)).alias("n_rows"))


@register("lookup_full_key", star_sql("""
select dat_metadata_id, count(*) as n_rows from fact_dat_measurements group by 1"""))
def lookup_full_key(spark, sf_dir):
    """Metadata id found on the whole header tuple, null-safe."""
    st = star_for(spark, sf_dir)
    return st.fact_dat_measurements.groupBy("dat_metadata_id").agg(F.count(F.lit(1)).alias("n_rows"))


_STAR_JOIN_SQL = """
select '{src}' as source, f.{key} as fact_id, mc.machine_name, ms.measurement_name, d.date, t.time,
  em.electrode_material, o.operator_name, f.voltage_v, f.current_a
from {fact} f join dim_machine mc using (machine_id) join dim_measurement ms using (measurement_id)
join dim_date d using (date_id) join dim_time t using (time_id)
join dim_electrode_material em using (electrode_material_id) left join dim_operator o using (operator_id)"""


@register("star_join", star_sql(
    _STAR_JOIN_SQL.format(src="excel", key="fact_excel_measurement_id", fact="fact_excel_measurements")
    + " union all " +
    _STAR_JOIN_SQL.format(src="dat", key="fact_dat_measurement_id", fact="fact_dat_measurements")))
def star_join(spark, sf_dir):
    """Both facts joined to their dimensions (denormalised readings)."""
    from cellstar.operators.lookup import broadcast_if_small
    st = star_for(spark, sf_dir)
    parts = []
    for src, fact, key in [("excel", st.fact_excel_measurements, "fact_excel_measurement_id"),
                           ("dat", st.fact_dat_measurements, "fact_dat_measurement_id")]:
        j = (fact.join(broadcast_if_small(st.dim_machine), "machine_id")
             .join(broadcast_if_small(st.dim_measurement), "measurement_id")
             .join(broadcast_if_small(st.dim_date), "date_id")
             .join(broadcast_if_small(st.dim_time), "time_id")
             .join(broadcast_if_small(st.dim_electrode_material), "electrode_material_id")
             .join(broadcast_if_small(st.dim_operator), "operator_id", "left"))
        parts.append(j.select(F.lit(src).alias("source"), F.col(key).alias("fact_id"), "machine_name",
                              "measurement_name", "date", "time", "electrode_material", "operator_name",
                              "voltage_v", "current_a"))
    return parts[0].unionByName(parts[1])


@register("union_readings", star_sql("""
select machine_name, measurement_name, timestamp, voltage_v, current_a from s1e
union all select machine_name, measurement_name, timestamp, voltage_v, current_a from s2c"""))
def union_readings(spark, sf_dir):
    """Readings of both machines on their shared columns."""
    st = star_for(spark, sf_dir)
    cols = ["machine_name", "measurement_name", "timestamp", "voltage_v", "current_a"]
    return st.silver_excel.select(*cols).unionByName(st.silver_dat.select(*cols))


@register("clean_readings", star_sql(
    "select measurement_name, timestamp, " + ", ".join(MEASURES) + " from s2c"))
def clean_readings(spark, sf_dir):
    """Machine 2 readings with unit-free names and typed values."""
    return star_for(spark, sf_dir).silver_dat.select("measurement_name", "timestamp", *MEASURES)


# --- sinks ----------------------------------------------------------------------------------------

_GOLD_TABLES = list(UNIQUE_KEYS)


@register("gold_publish", star_sql(" union all ".join(
    f"select '{t}' as table_name, count(*) as n_rows from {t}" for t in _GOLD_TABLES)))
def gold_publish(spark, sf_dir):
    """Publish the nine tables twice; the second run changes nothing."""
    from functools import reduce
    tables = _tables(spark, sf_dir)
    root = scratch_dir(spark, "gold")
    PUB.publish(tables, root)
    paths = PUB.publish(tables, root)
    return reduce(lambda a, b: a.unionByName(b), [
        PUB.read_table(spark, p).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"),
                                                                                "n_rows")
        for t, p in paths.items()])


@register("publish_versions", star_sql(" union all ".join(
    f"select cast({v} as bigint) as version, '{t}' as table_name, count(*) as n_rows, cast(sum(hash_key) as bigint) as key_sum "
    f"from (select {k} as hash_key from {t}) t where {v} = 2 or hash_key % 2 = 0"
    for v in (1, 2) for t, k in zip(_GOLD_TABLES, (UNIQUE_KEYS[t][0][0] for t in _GOLD_TABLES)))))
def publish_versions(spark, sf_dir):
    """Two versions of the nine tables (members of even key, then all),
    with a publication between them that fails at its sixth table and one that
    comes second; both versions read back, each with its own rows."""
    from functools import reduce
    tables = _tables(spark, sf_dir)
    root = scratch_dir(spark, "versions")
    keys = {t: UNIQUE_KEYS[t][0][0] for t in tables}
    PUB.publish({t: df.filter(F.col(keys[t]) % 2 == 0) for t, df in tables.items()}, root)
    broken = {t: df.filter(F.raise_error(F.lit("no such load")).isNotNull()) if i == 5 else df.limit(0)
              for i, (t, df) in enumerate(tables.items())}
    try:
        PUB.publish(broken, root)
    except Exception as e:  # the version before stays
        if "no such load" not in str(e):
            raise
    late = V.prepare(spark, root, {t: df.limit(0) for t, df in tables.items()})
    PUB.publish(tables, root)
    try:
        V.commit(spark, late)
    except V.Conflict:
        pass
    return reduce(lambda a, b: a.unionByName(b), [
        df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(keys[t]).alias("key_sum")).select(
            F.lit(v).cast("long").alias("version"), F.lit(t).alias("table_name"), "n_rows", "key_sum")
        for v in V.list_versions(spark, root) for t, df in PUB.read_published(spark, root, v).items()])


@register("silver_roundtrip", star_sql(
    "select table_name, record_ID, cycle, step_ID, step_name, time_in_step, voltage_V, current_mA, "
    "capacity_mAh, energy_mWh, timestamp from sheet"))
def silver_roundtrip(spark, sf_dir):
    """Create a table from the first batch (fails if it exists), append the rest, read back."""
    sheet = fx.sheet_rows(fx.readings(spark, sf_dir)).drop("Validated")
    even = measurement_name("table_name").cast("bigint") % 2 == 0
    path = scratch_dir(spark, "silver")
    PUB.create_table(sheet.filter(even), path)
    try:
        PUB.create_table(sheet.filter(even), path)
        raise AssertionError("creating an existing table must fail")
    except AssertionError:
        raise
    except Exception:  # the expected "already exists" error
        pass
    PUB.append(sheet.filter(~even), path)
    return PUB.read_table(spark, path)


@register("replace_table", star_sql(
    "select measurement_name, timestamp, " + ", ".join(MEASURES) +
    ", operator_name, diaphragm, thickness, porosity, electrolyte, electrodes, electrodes_area, "
    "current_density_mode, current_density_value, pump_speed_mode, pump_speed_value, "
    "experiment_running_time from s2c"))
def replace_table(spark, sf_dir):
    """Create-or-replace by measurement partition: reloading a
    measurement replaces its rows and leaves the others, so re-runs do not grow."""
    rows = read_bronze(spark, sf_dir)
    path = scratch_dir(spark, "replace")
    PUB.replace_table(rows, path, partition_by=["measurement_name"])
    again = rows.filter(F.col("measurement_name").startswith("20"))
    PUB.replace_table(again, path, partition_by=["measurement_name"])
    return PUB.read_table(spark, path, schema=rows.schema)


@register("preview", star_sql(" union all ".join(
    f"select * from (select '{t}' as table_name, {k} as key from {t} order by {k} limit 5)"
    for t, k in [(t, sets[0][0]) for t, sets in UNIQUE_KEYS.items()])))
def preview(spark, sf_dir):
    """H2: first five keys of each table, in key order."""
    from functools import reduce
    st = _tables(spark, sf_dir)
    return reduce(lambda a, b: a.unionByName(b), [
        PUB.preview(st[t].select(F.col(sets[0][0]).alias("key")), ["key"], 5)
        .select(F.lit(t).alias("table_name"), "key")
        for t, sets in UNIQUE_KEYS.items()])



_LOADS = """
, loads as (
  select 'excel' as source, ms.measurement_name, f.timestamp, f.record_id, f.voltage_v, f.current_a, o.operator_name,
    o.operator_level, em.electrode_material, ms.start_timestamp, ms.finish_timestamp
  from fact_excel_measurements f join dim_measurement ms using (measurement_id)
    join dim_operator o using (operator_id) join dim_electrode_material em using (electrode_material_id)
  union all
  select 'dat', ms.measurement_name, f.timestamp, null, f.voltage_v, f.current_a, o.operator_name, o.operator_level,
    em.electrode_material, ms.start_timestamp, ms.finish_timestamp
  from fact_dat_measurements f join dim_measurement ms using (measurement_id)
    left join dim_operator o using (operator_id) join dim_electrode_material em using (electrode_material_id))
"""


@register("warehouse_incremental", star_sql(_LOADS + """
select *, case when cast(measurement_name as bigint) % 3 = 2 then true end as key_kept from loads"""))
def warehouse_incremental(spark, sf_dir):
    """H6: two loads give the rows of one. The first holds the measurements
    numbered 2 modulo 3 and half of the readings of those numbered 1; the second
    all of the latter and the rest. Keys of the first load stay."""
    from cellstar.plans.star import build_star, update_star
    rd = readings_for(spark, sf_dir)
    number = measurement_name("table_name").try_cast("bigint") % 3
    rows = {"sheet": stage(fx.sheet_rows(rd), "load_sheet"), "dat": stage(fx.dat_rows(rd), "load_dat")}
    meta = fx.metadata_rows(rd)
    early = (number == 2) | ((number == 1) & (F.col("record_id") % 2 == 0))
    first = build_star(rows["sheet"].filter(early), rows["dat"].filter(early),
                       meta.filter(F.col("measurement_name").try_cast("bigint") % 3 == 2))
    root = scratch_dir(spark, "warehouse")
    PUB.publish(first.tables(), root)
    tables = PUB.read_published(spark, root)
    late = F.coalesce(number != 2, F.lit(True))
    st = update_star(tables, rows["sheet"].filter(late), rows["dat"].filter(late), meta)
    parts = []
    for source, fact, before, key in (
            ("excel", st.fact_excel_measurements, tables["fact_excel_measurements"], "fact_excel_measurement_id"),
            ("dat", st.fact_dat_measurements, tables["fact_dat_measurements"], "fact_dat_measurement_id")):
        old = before.select(key, F.col("measurement_id").alias("_m"), F.col("timestamp").alias("_t"))
        j = (fact.join(broadcast_if_small(st.dim_measurement), "measurement_id")
             .join(broadcast_if_small(st.dim_operator), "operator_id", "left")
             .join(broadcast_if_small(st.dim_electrode_material), "electrode_material_id").join(old, key, "left"))
        kept = F.when(F.col("measurement_name").cast("bigint") % 3 == 2,
                      (F.col("_m") == F.col("measurement_id")) & (F.col("_t") == F.col("timestamp")))
        record = F.col("record_id") if source == "excel" else F.lit(None).cast("long")
        parts.append(j.select(F.lit(source).alias("source"), "measurement_name", "timestamp", record.alias("record_id"),
                              "voltage_v", "current_a", "operator_name", "operator_level", "electrode_material",
                              "start_timestamp", "finish_timestamp", kept.alias("key_kept")))
    return parts[0].unionByName(parts[1])


@register("fact_incremental", star_sql("""
select cast(row_number() over (order by coalesce(cast(ms.measurement_name as bigint) % 4 = 1, false) desc,
         ms.measurement_name, f.timestamp, f.fact_dat_measurement_id) as bigint) as fact_dat_measurement_id,
  f.measurement_id, f.timestamp, f.voltage_v, f.operator_id
from fact_dat_measurements f join dim_measurement ms using (measurement_id)"""))
def fact_incremental(spark, sf_dir):
    """The machine 2 fact loaded in two batches (measurements numbered
    1 modulo 4, then all others); the second batch's keys continue after the first's
    maximum, as a table that is kept and grows."""
    from cellstar.plans.star import build_fact_dat
    st = star_for(spark, sf_dir)
    dims = {k: v for k, v in st.tables().items() if k.startswith("dim_")}
    early = F.coalesce(F.col("measurement_name").try_cast("bigint") % 4 == 1, F.lit(False))
    first = build_fact_dat(st.silver_dat.filter(early), dims)
    second = build_fact_dat(st.silver_dat.filter(~early), dims, existing=first)
    cols = ["fact_dat_measurement_id", "measurement_id", "timestamp", "voltage_v", "operator_id"]
    return first.select(*cols).unionByName(second.select(*cols))


# --- states of the questions ----------------------------------------------------------------------

def _three_loads(spark, sf_dir):
    """The published tables after three loads, states of the questions among
    them: measurements numbered 2 modulo 3 and half of the readings of those
    numbered 1; all readings of the latter; the rest."""
    from cellstar.plans import states as ST
    from cellstar.plans.star import build_star, update_star

    def build():
        rd = readings_for(spark, sf_dir)
        number = F.coalesce(measurement_name("table_name").try_cast("bigint") % 3, F.lit(0))
        rows = {"sheet": stage(fx.sheet_rows(rd), "loads_sheet"), "dat": stage(fx.dat_rows(rd), "loads_dat")}
        meta = fx.metadata_rows(rd)
        root = scratch_dir(spark, "loads")
        for load in ((number == 2) | ((number == 1) & (F.col("record_id") % 2 == 0)), number == 1, number == 0):
            part = rows["sheet"].filter(load), rows["dat"].filter(load), meta
            before = PUB.read_published(spark, root)
            star = update_star({k: v for k, v in before.items() if k not in ST.STATES}, *part) if before else build_star(*part)
            fresh = star.fresh_facts or star.tables()
            states = ST.measurement_states(fresh["fact_excel_measurements"], fresh["fact_dat_measurements"],
                                           star.dim_dat_metadata)
            if before and not star.replaced:    # new measurements only: the facts and states grow by a folder each
                whole, grown = {k: v for k, v in star.tables().items() if k not in fresh}, {**fresh, **states}
            else:
                whole, grown = {**star.tables(), **(ST.replace_states(before, states) if before else states)}, {}
            PUB.publish(whole, root, append=grown, carry=bool(grown))
        return PUB.read_published(spark, root)

    return memo("three_loads", spark, sf_dir, build)


@register("q1_from_states", ORACLES["q1_material_by_density"])
def q1_from_states(spark, sf_dir):
    """N10 with B9: from the states that three loads left; no fact is read."""
    from cellstar.plans import states as ST
    t = _three_loads(spark, sf_dir)
    return ST.q1_material_by_density(t, t["dim_electrode_material"])


@register("q2_from_states", ORACLES["q2_machine_compare"])
def q2_from_states(spark, sf_dir):
    """N11 with B9: from the states that three loads left; no fact is read."""
    from cellstar.plans import states as ST
    t = _three_loads(spark, sf_dir)
    return ST.q2_machine_compare(t, t["dim_machine"], t["dim_electrode_material"])


@register("q3_from_states", ORACLES["q3_degradation"])
def q3_from_states(spark, sf_dir):
    """N12 with B9: from the states that three loads left, folded to one part a measurement."""
    from cellstar.plans import states as ST
    t = _three_loads(spark, sf_dir)
    return ST.q3_degradation(ST.compact(t), t["dim_electrode_material"])


@register("q4_from_states", ORACLES["q4_h2_output"])
def q4_from_states(spark, sf_dir):
    """N13 with B9: from the states that three loads left, folded to one part a measurement."""
    from cellstar.plans import states as ST
    t = _three_loads(spark, sf_dir)
    folded = {k: stage(df, k) for k, df in ST.compact(t).items()}
    return ST.q4_h2_output(folded, t["dim_electrode_material"], folded=True)


# --- layout --------------------------------------------------------------------------------------

@register("clustered_facts", star_sql("""
select measurement_id, date_id, count(*) as n_rows, sum(voltage_v) as sum_voltage, min(timestamp) as first_timestamp,
  max(timestamp) as last_timestamp
from (select measurement_id, date_id, voltage_v, timestamp from fact_excel_measurements
      union all select measurement_id, date_id, voltage_v, timestamp from fact_dat_measurements)
group by measurement_id, date_id"""))
def clustered_facts(spark, sf_dir):
    """Both facts written along the curve of (measurement, date) and
    read back: the readings of each measurement and day."""
    from cellstar.sinks import clustered as CL
    st, parts = star_for(spark, sf_dir), []
    for fact in (st.fact_excel_measurements, st.fact_dat_measurements):
        path = CL.write(fact, scratch_dir(spark, "clustered"))
        parts.append(CL.read(spark, path, fact.schema).select("measurement_id", "date_id", "voltage_v", "timestamp"))
    return parts[0].unionByName(parts[1]).groupBy("measurement_id", "date_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("voltage_v").cast("decimal(38,4)").alias("sum_voltage"),
        F.min("timestamp").alias("first_timestamp"), F.max("timestamp").alias("last_timestamp"))


# --- documents of any shape ---------------------------------------------------------------------

_EVEN = "cast(measurement_name as bigint) % 2 = 0"


@register("document_fields", star_sql(f"""
select json_name as document, 'json_name' as field, '"' || json_name || '"' as value from meta
union all select json_name, 'operator_name', '"' || operator_name || '"' from meta
union all select json_name, 'cell', '{{"level":"' || operator_level || '","number":' ||
  cast(cast(measurement_name as bigint) as varchar) || '}}' from meta
union all select json_name, 'rating', case when {_EVEN} then '"' || operator_level || '"'
  else cast(cast(measurement_name as bigint) % 5 as varchar) end from meta
union all select json_name, 'seen', '[1,"two",null]' from meta where {_EVEN}"""))
def document_fields(spark, sf_dir):
    """Documents with nested and unknown fields stored as VARIANT; a
    second load turns a number into text and adds a list for every other
    measurement. All fields after the merge, as JSON."""
    from cellstar.operators import documents as DOC
    meta = fx.metadata_rows(fx.readings(spark, sf_dir))
    number = F.col("measurement_name").cast("bigint")
    first = meta.select(F.to_json(F.struct("json_name", "operator_name", F.struct(
        F.col("operator_level").alias("level"), number.alias("number")).alias("cell"),
        (number % 5).alias("rating"))).alias("value"))
    second = meta.filter(number % 2 == 0).select(F.concat(
        F.lit('{"json_name":"'), F.col("json_name"), F.lit('","rating":"'), F.col("operator_level"),
        F.lit('","seen":[1,"two",null]}')).alias("value"))
    stored = stage(DOC.read(first, LOAD_TIME), "variant_documents")
    merged = stage(DOC.merge(stored, DOC.read(second, "2024-03-01 00:00:00")), "variant_documents")
    return DOC.fields(merged).select("document", "field", "value")
