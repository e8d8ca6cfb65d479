"""File catalogue, configuration and ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Nanoseconds of each peaking-time code.
PEAKING_NS = {0: 76, 1: 123, 2: 180, 3: 228, 4: 283, 5: 328, 6: 388, 7: 433, 8: 578}


def name_fields(path: Column, greedy: bool = True) -> tuple[Column, Column]:
    """File number and unit from ``_NNN_FF`` in a name: its last place, or its first; null without one."""
    pattern = r"^.*_(\d{3})_(\d{2})" if greedy else r"^.*?_(\d{3})_(\d{2})"
    name = F.substring_index(path, "/", -1)
    number = lambda k: F.nullif(F.regexp_extract(name, pattern, k), F.lit("")).cast("int")
    return number(1), number(2)


def catalogue(files: DataFrame, greedy: bool = True) -> DataFrame:
    """``files`` (with ``path``) and file_num, feu and kind: data, pedestal or other."""
    num, feu = name_fields(F.col("path"), greedy)
    kind = F.when(F.col("path").contains("_datrun_"), "data").when(F.col("path").contains("_pedthr_"), "pedestal").otherwise("other")
    return files.withColumns({"file_num": num, "feu": feu, "kind": kind})


def without_units(files: DataFrame, excluded: tuple[int, ...] = (1,)) -> DataFrame:
    return files.filter(F.col("feu").isNotNull() & ~F.col("feu").isin(list(excluded)))


def resolve_pedestals(data: DataFrame, pedestals: DataFrame, keys: list[str], many: str = "skip") -> DataFrame:
    """Data files with their unit's pedestal; of several, skip the data file, take the first, or take none."""
    found = pedestals.groupBy(*keys).agg(F.count("*").alias("found"), F.min("path").alias("pedestal_path"))
    out = data.join(found, keys, "left").withColumn("found", F.coalesce("found", F.lit(0)))
    if many == "skip":
        return out.filter("found <= 1")
    return out if many == "first" else out.withColumn("pedestal_path", F.when(F.col("found") == 1, F.col("pedestal_path")))


def pedestal_folder(choice: Column, same: Column, base: Column, named: Column) -> Column:
    """Where a run's pedestals lie, null where that isn't known and the run is skipped.

    By ``choice``: "same" is beside the data, "abs" the pedestal folder ``base`` itself, "find" the pedestals of the run below it that a
    file beside the data names (``named``: its content, null without the file).
    """
    run = F.regexp_replace(named, r"^\s+|\s+$", "")
    found = F.concat(F.regexp_replace(base, "/$", ""), F.when(run == "", "").otherwise(F.concat(F.lit("/"), run)), F.lit("/pedestals"))
    return F.when(choice == "same", same).when(choice == "abs", base).when(choice == "find", found)


def combined_groups(files: DataFrame, excluded: tuple[int, ...] = (1,)) -> DataFrame:
    """Hit files of one number in one folder (so of one sub-run), a file for each unit, and the name of their union.

    Files without a number and those of ``excluded`` units are left out; of two files of one unit the last by name counts.
    """
    own = files.filter(F.col("file_num").isNotNull() & F.col("feu").isNotNull() & ~F.col("feu").isin(*excluded))
    one = own.groupBy(F.regexp_replace("path", "/?[^/]*$", "").alias("folder"), "file_num", "feu").agg(F.max("path").alias("path"))
    first = F.element_at(F.split(F.min("path"), "/"), -1)
    name = F.regexp_replace(first, r"_(\d{3})_(\d{2})(?!.*_\d{3}_\d{2})", "_$1_feu-combined")
    return one.groupBy("folder", "file_num").agg(F.sort_array(F.collect_list("path")).alias("paths"), name.alias("combined"))


def peaking_times(lines: DataFrame) -> DataFrame:
    """``feu_key, ns`` from configuration lines (``line_no, value``): the last line of a key wins."""
    bare = F.trim(F.substring_index("value", "#", 1))
    t = lines.select("line_no", F.split(bare, r"\s+").alias("t"))
    t = t.filter((F.size("t") >= 7) & (F.col("t")[0] == "Feu") & (F.col("t")[2] == "Dream") & (F.col("t")[4] == "1"))
    word = F.when(F.col("t")[6].rlike("^(0[xX])?[0-9a-fA-F]+$"), F.conv(F.regexp_replace(F.col("t")[6], "^0[xX]", ""), 16, 10).cast("long"))
    code = F.shiftright(word, 4).bitwiseAND(0xF)
    table = F.create_map(*[F.lit(x) for kv in PEAKING_NS.items() for x in kv])
    known = t.select("line_no", F.col("t")[1].alias("feu_key"), F.try_element_at(table, code.cast("int")).alias("ns")).filter("ns is not null")
    return known.groupBy("feu_key").agg(F.max_by("ns", "line_no").alias("ns"))


def gate_widths(units: DataFrame, peaking: DataFrame, tps: Column) -> DataFrame:
    """``units`` with ``width``: from the unit's own peaking time or that of ``*``; null without either."""
    own = peaking.filter("feu_key <> '*'").select(F.col("feu_key").cast("int").alias("feu"), F.col("ns").alias("own_ns"))
    every = peaking.filter("feu_key = '*'").select(F.col("ns").alias("any_ns"))
    out = units.join(own, "feu", "left").join(every, F.lit(True), "left")
    ns = F.coalesce("own_ns", "any_ns")
    return out.withColumn("width", F.when(ns.isNotNull(), F.greatest(F.lit(3), F.bround(1.7 * ns / tps).cast("int")))).drop("own_ns", "any_ns")


def zs_baseline(zero_suppress: Column, pedestal_subtraction: Column) -> Column:
    return F.coalesce(zero_suppress & pedestal_subtraction, F.lit(False))


def choose_config(files: DataFrame, keys: list[str], runs: DataFrame | None = None, templates: DataFrame | None = None) -> DataFrame:
    """One configuration for each run: a copy beside the data, a data run's first, then by name; else the template.

    ``runs`` has ``keys`` and the template's path as the run names it; it is looked for in ``templates`` (``path, rank``:
    the place of its folder in the search), as it is first, then by base name.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.col("path").contains("datrun").cast("int").desc(), "path"))
    copies = files.filter(F.col("path").endswith(".cfg_cpy")).withColumn("rank", rank).filter("rank = 1").select(*keys, "path")
    if runs is None:
        return copies
    wanted = runs.filter("daq_config_template_path <> ''").select(*keys, F.col("daq_config_template_path").alias("wanted"))
    base = lambda c: F.substring_index(c, "/", -1)
    found = wanted.join(templates.select(F.col("path").alias("template"), F.col("rank").alias("place")), base(F.col("wanted")) == base(F.col("template")))
    best = found.groupBy(*keys).agg(F.min_by("template", F.struct((F.col("wanted") != F.col("template")).cast("int"), "place", "template")).alias("template"))
    return copies.join(best, keys, "full").select(*keys, F.coalesce("path", "template").alias("path"))


def only_runs(files: DataFrame, part: str) -> DataFrame:
    return files.filter(F.col("run").contains(part) | F.col("sub_run").contains(part))


def pending(tasks: DataFrame, ledger: DataFrame, key: str = "key") -> DataFrame:
    """Tasks that the ledger doesn't call ok."""
    return tasks.join(ledger.filter("status = 'ok'").select(key), key, "left_anti")


def undecoded_pedestals(files: DataFrame, made: str = ".root") -> DataFrame:
    """Pedestal frame files that have no product of their name beside them yet."""
    own = files.filter(F.col("path").contains("_pedthr_") & F.col("path").endswith(".fdf"))
    there = files.filter(F.col("path").endswith(made)).select(F.col("path").alias("product")).distinct()
    return own.join(there, F.regexp_replace("path", r"\.fdf$", made) == F.col("product"), "left_anti")


def ledger_summary(ledger: DataFrame) -> DataFrame:
    """Count and seconds by stage (the key up to its colon) and status."""
    return ledger.groupBy(F.split_part("key", F.lit(":"), F.lit(1)).alias("stage"), "status").agg(F.count("*").alias("n"), F.sum(F.coalesce("secs", F.lit(0.0))).alias("secs"))


def first_failures(ledger: DataFrame, k: int = 40, order: str | None = None) -> DataFrame:
    """The first failed tasks in the order of the ledger (``order``, a line number), or by key."""
    return ledger.filter("status = 'failed'").orderBy(order or "key").limit(k)


def validated(products: DataFrame, least: int = 10_240) -> DataFrame:
    """``status`` and ``reason`` from return code and size; a missing product has size 0."""
    size = F.coalesce("bytes", F.lit(0).cast("long"))
    reason = F.when(F.col("rc") != 0, "nonzero exit").when(size < least, F.concat(F.lit("output "), size.cast("string"), F.lit(" bytes")))
    return products.withColumn("reason", reason).withColumn("status", F.when(F.col("reason").isNull(), "ok").otherwise("failed"))


def folder_sizes(files: DataFrame) -> DataFrame:
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return files.groupBy(folder.alias("folder")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
