"""Macro variables, includes and macro calls, within programs and across them.

A program is read in text order by ``functions.programs``. What it needs from
others is brought to it by joins: the definitions its includes make (folded over
the include graph, round by round), the paths of includes whose text has
references (each round may settle more of them), and the macros it calls.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from threadline.config import ParseOptions
from threadline.functions import extract, macros, programs
from threadline.functions.paths import base_name, candidate_path, plain_path
from threadline.plans.scratch import Scratch
from threadline.plans.skew import find_hot_keys, partitioned, skew_join

# Tasks get the reader by value, so workers need not have this package.
cloudpickle.register_pickle_by_value(programs)

_INCLUDED = f"array<struct<site: int, entries: array<{programs.ENTRY}>>>"
_MACROS = f"array<{programs.MACRO}>"


def macro_definitions(files: DataFrame) -> DataFrame:
    """Macro variables (last definition wins) and macros defined per file."""
    code = F.coalesce(F.col("code"), F.lit(""))
    return files.select(
        "file_path",
        macros.definition_map(macros.let_definitions(code)).alias("macro_definitions"),
        macros.macro_names(code).alias("macros_defined"),
    )


def dynamic_files(raw: DataFrame) -> DataFrame:
    """Files that need resolution."""
    return raw.filter(F.col("has_dynamic_deps"))


@dataclass(frozen=True)
class Resolution:
    """Programs as read with what reaches them, and their include links."""

    read: DataFrame  # file_path, code, text, total, open, definitions
    links: DataFrame  # file_path, include_file, candidate, resolved_path


def _read(
    files: DataFrame, included: DataFrame | None = None, called: DataFrame | None = None, sites_only: bool = False
) -> DataFrame:
    """``programs.READ`` rows of (file_path, code) with what their includes bring and the macros they call."""
    given = files.select("file_path", "code")
    given = given.withColumn("included", F.lit(None).cast(_INCLUDED)) if included is None else given.join(included, "file_path", "left")
    given = given.withColumn("macros", F.lit(None).cast(_MACROS)) if called is None else given.join(called, "file_path", "left")
    given = given.select("file_path", "code", "included", "macros")
    if sites_only:
        return given.mapInArrow(programs.read_sites, programs.SITES)
    return given.mapInArrow(programs.read_programs, programs.READ)


def _sites(read: DataFrame) -> DataFrame:
    """(file_path, site, include_file, candidate) of every include, its path as read."""
    sites = read.select("file_path", F.inline("sites"))
    return sites.select("file_path", "site", "include_file", candidate_path(F.col("file_path"), F.col("path")).alias("candidate"))


def _first_sites(including: DataFrame) -> DataFrame:
    """``programs.SITES`` rows of the programs on their own. Where nothing is defined and no path has references, paths are as written."""
    defining = F.rlike("code", F.lit(programs.DEFINING))
    open_path = F.contains("code", F.lit("&")) & F.rlike("code", F.lit(extract.OPEN_INCLUDE))
    changing = F.coalesce(defining | open_path, F.lit(False))
    paths = extract.all_matches(F.col("code"), extract.INCLUDE)
    site = F.transform(paths, lambda p, i: F.struct(i.alias("site"), p.alias("include_file"), p.alias("path")))
    plain = including.filter(~changing).select("file_path", site.alias("sites"))
    return _read(including.filter(changing), sites_only=True).unionByName(plain)


def _targets(sites: DataFrame, paths: DataFrame, scratch: Scratch, known: DataFrame | None = None) -> DataFrame:
    """(candidate, resolved_path) of all candidates so far; only those not yet ``known`` are looked up.

    A path with an open reference stands for no file and is not among them.
    """
    settled = sites.filter(~F.contains("candidate", F.lit("&"))).select("candidate").distinct()
    if known is not None:
        settled = settled.join(known, "candidate", "left_anti")
    settled, rows = scratch.save_counted(settled, "candidates")
    if known is not None and not rows:
        return known
    found = settled.join(include_targets(settled, paths), "candidate", "left").select("candidate", "resolved_path")
    return scratch.save(found if known is None else known.unionByName(found), "targets")


def _linked(sites: DataFrame, targets: DataFrame) -> DataFrame:
    """Sites with the file they stand for."""
    hot = find_hot_keys(sites, "candidate")
    return skew_join(sites, targets, "candidate", "left", hot_left=hot, by_left=["file_path", "site"]).select(
        "file_path", "site", "include_file", "candidate", "resolved_path"
    )


def _brought(links: DataFrame, exports: DataFrame) -> DataFrame:
    """(file_path, included): the definitions each include site brings; a file that includes itself brings nothing."""
    links = links.filter(F.col("resolved_path") != F.col("file_path")).select("file_path", "site", "resolved_path")
    exports = exports.filter(F.size("entries") > 0).select(F.col("file_path").alias("resolved_path"), "entries")
    # A common include may be the target of a large share of all links.
    met = skew_join(links, exports, "resolved_path", hot_left=find_hot_keys(links, "resolved_path"), by_left=["file_path", "site"])
    return met.groupBy("file_path").agg(F.array_sort(F.collect_list(F.struct("site", "entries"))).alias("included"))


def program_links(files: DataFrame, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """(file_path, site, include_file, candidate, resolved_path) of all includes, and
    (file_path, included): the definitions that reach each program through them.

    Only files that others include, and files with references in include paths,
    are read again in a round, and of these only those for which their includes
    now bring something else. A round may settle paths that need a value from
    another include; the next looks up what these bring. Rounds end when nothing
    changes: after as many as includes are deep. A definition that comes back to
    the program that made it does not count, so circles add nothing; should
    values within one still alternate, the number of files read ends the loop.
    """
    spark = files.sparkSession
    scratch = scratch or Scratch(spark, "programs")
    paths = files.select("file_path")
    including = files.filter(F.rlike("code", F.lit(extract.INCLUDE)))
    first = scratch.save(_first_sites(including), "first")
    sites = _sites(first)
    targets = _targets(sites, paths, scratch)
    moving = first.filter(F.exists("sites", lambda s: F.contains(s["include_file"], F.lit("&")))).select("file_path")
    moving = scratch.save(moving, "moving")
    # Links of files without references in include paths are settled once; a round writes the others only.
    links = scratch.save(_linked(sites, targets), "links")
    fixed = scratch.save(links.join(moving, "file_path", "left_anti"), "fixed")
    loose = scratch.save(links.join(moving, "file_path", "left_semi"), "loose")
    fixed_wanted = scratch.save(_included_files(fixed).unionByName(moving).distinct(), "wanted")
    nothing = spark.createDataFrame([], f"file_path string, included {_INCLUDED}")
    state, seen, rounds, bodies = None, None, 0, None
    while True:
        wanted = scratch.save(fixed_wanted.unionByName(_included_files(loose)).distinct(), "wanted")
        links = fixed.unionByName(loose)
        included = nothing
        if state is not None:
            included = scratch.save(_brought(links.join(wanted, "file_path", "left_semi"), state), "included")
        marks = wanted.join(included, "file_path", "left").select("file_path", F.xxhash64("included").alias("mark"))
        if seen is None:
            marks = marks.withColumn("changed", F.lit(True))
        else:
            before = seen.select("file_path", F.col("mark").alias("before"))
            marks = marks.join(before, "file_path", "left").select("file_path", "mark", (~F.col("mark").eqNullSafe(F.col("before"))).alias("changed"))
        marks, rows = scratch.save_counted(marks, "marks", F.col("changed"))
        todo = marks.filter("changed").select("file_path")
        rounds += 1
        most = marks.count() + 2 if rounds > 50 else rounds  # deeper than includes usually are: no more rounds than files
        if not rows or rounds > most:
            break
        # Texts are fetched once, when a file is wanted for the first time.
        lacking = wanted if bodies is None else wanted.join(bodies, "file_path", "left_anti")
        lacking, rows = scratch.save_counted(lacking, "lacking")
        if rows or bodies is None:
            fetched = scratch.save(files.join(lacking, "file_path", "left_semi").select("file_path", "code"), "bodies")
            bodies = fetched if bodies is None else bodies.unionByName(fetched)
        again = _read(bodies.join(todo, "file_path", "left_semi"), included).select("file_path", "sites", "entries")
        again = scratch.save(again, "again")
        if state is not None:
            again = again.unionByName(state.join(todo, "file_path", "left_anti"))
        state, seen = scratch.save(again, "state"), marks
        # Paths can have changed only in files that were read again and have references in them.
        turned, rows = scratch.save_counted(state.join(todo, "file_path", "left_semi").join(moving, "file_path", "left_semi"), "turned")
        if rows:
            targets = _targets(_sites(turned), paths, scratch, targets)
            kept = loose.join(turned.select("file_path"), "file_path", "left_anti")
            loose = scratch.save(kept.unionByName(_linked(_sites(turned), targets)), "loose")
    return links, nothing if state is None else scratch.save(_brought(links, state), "brought")


def _included_files(links: DataFrame) -> DataFrame:
    return links.select(F.col("resolved_path").alias("file_path")).filter(F.col("file_path").isNotNull()).distinct()


def called_macros(files: DataFrame, links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(file_path, macros): the macros defined elsewhere that each program may call, those they call included.

    A name means the definition that the program's includes bring nearest, or
    else the only one in the corpus; several elsewhere decide nothing. A
    program's own definitions are in its text and not listed.
    """
    spark = files.sparkSession
    scratch = scratch or Scratch(spark, "macros")
    defining = files.filter(F.rlike("code", F.lit(extract.MACRO_DEFINITION))).select("file_path", "code")
    headers, rows = scratch.save_counted(defining.mapInArrow(programs.macro_headers, programs.HEADERS), "headers")
    if not rows:
        return spark.createDataFrame([], f"file_path string, macros {_MACROS}")
    names = headers.groupBy("name").agg(F.min("file_path").alias("only"), F.max("file_path").alias("other"))
    names = names.select("name", F.when(F.col("only") == F.col("other"), F.col("only")).alias("only"))

    def named(text: str) -> Column:
        return F.explode(F.array_distinct(F.transform(extract.all_matches(F.col(text), f"{extract.FLAGS}%([{extract.WORD}]++)"), F.lower)))

    words = files.filter(F.contains("code", F.lit("%"))).select("file_path", named("code").alias("name"))
    own = headers.select("file_path", "name")
    calls = words.join(names, "name").join(own, ["file_path", "name"], "left_anti")
    calls, n_calls = scratch.save_counted(calls, "calls")
    # Definitions several files make: the one that the program's own includes reach first.
    several = calls.filter(F.col("only").isNull())
    reach = None
    if several.limit(1).count():
        roots = several.select("file_path").distinct()
        reach = scratch.save(_reached(roots, links, scratch), "reach")

    def settled(calls: DataFrame) -> DataFrame:
        sure = calls.filter(F.col("only").isNotNull()).select("file_path", "name", F.col("only").alias("at"))
        if reach is None:
            return sure
        choice = calls.filter(F.col("only").isNull()).select("file_path", "name")
        choice = choice.join(reach, "file_path").join(headers.select(F.col("file_path").alias("at"), "name"), ["at", "name"])
        nearest = choice.groupBy("file_path", "name").agg(F.min(F.struct("level", "at")).alias("best"))
        return sure.unionByName(nearest.select("file_path", "name", F.col("best.at").alias("at")))

    inner = headers.select(F.col("file_path").alias("at"), F.col("name").alias("outer"), named("body").alias("name"))
    inner = scratch.save(inner.join(names, "name"), "inner")
    found, rows = scratch.save_counted(settled(calls), "found")
    needed = [found]
    while rows:
        # Macros that the new ones call, as the calling program sees them.
        step = found.withColumnRenamed("name", "outer").join(inner, ["at", "outer"]).select("file_path", "name", "only").distinct()
        step = settled(step).join(own, ["file_path", "name"], "left_anti").join(_union(needed).select("file_path", "name"), ["file_path", "name"], "left_anti")
        found, rows = scratch.save_counted(step, "found")
        if rows:
            needed.append(found)
    needs = scratch.save(_union(needed).withColumn("key", F.concat_ws("\u0000", "at", "name")), "needs")
    bodies = headers.select(F.concat_ws("\u0000", "file_path", "name").alias("key"), F.struct("name", "params", "body").alias("macro"))
    met = skew_join(needs, bodies, "key", hot_left=find_hot_keys(needs, "key"), by_left=["file_path"])
    return met.groupBy("file_path").agg(F.array_sort(F.collect_list("macro")).alias("macros"))


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for f in frames[1:]:
        result = result.unionByName(f)
    return result


def _reached(roots: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """(file_path, at, level): files that each root reaches by includes, with the fewest steps."""
    steps = links.filter(F.col("resolved_path").isNotNull()).select("file_path", F.col("resolved_path").alias("to")).distinct()
    found, rows = scratch.save_counted(roots.join(steps, "file_path").select("file_path", F.col("to").alias("at")).distinct(), "reach1")
    levels = [found.withColumn("level", F.lit(1))]
    while rows:
        step = found.join(steps.withColumnRenamed("file_path", "at"), "at").select("file_path", F.col("to").alias("at")).distinct()
        found, rows = scratch.save_counted(step.join(_union(levels), ["file_path", "at"], "left_anti"), "reach")
        levels.append(found.withColumn("level", F.lit(len(levels) + 1)))
    return _union(levels)


@dataclass(frozen=True)
class ReadingPlan:
    """What reaches programs from others: include links, definitions by include, macros."""

    links: DataFrame
    included: DataFrame
    called: DataFrame
    scratch: Scratch


def plan_reading(files: DataFrame, scratch: Scratch | None = None) -> ReadingPlan:
    scratch = scratch or Scratch(files.sparkSession, "resolve")
    links, included = program_links(files, scratch)
    return ReadingPlan(links, included, scratch.save(called_macros(files, links, scratch), "called"), scratch)


def reading_contents(files: DataFrame, plan: ReadingPlan) -> DataFrame:
    """(file_path, content): a hash of the text and of all that reaches the program, its include links among it."""
    links = plan.links.groupBy("file_path").agg(F.array_sort(F.collect_list(F.struct("site", "candidate", "resolved_path"))).alias("links"))
    given = files.select("file_path", F.sha2(F.coalesce("code", F.lit("")), 256).alias("code"))
    given = given.join(plan.included, "file_path", "left").join(plan.called, "file_path", "left").join(links, "file_path", "left")
    return given.select("file_path", F.sha2(F.to_json(F.struct("code", "included", "macros", "links")), 256).alias("content"))


def read_corpus(
    files: DataFrame, scratch: Scratch | None = None, plan: ReadingPlan | None = None, only: DataFrame | None = None
) -> Resolution:
    """Every program that needs resolution, read with what reaches it from others.

    Programs need it when they hold a reference, or call a macro that another
    file defines. ``only`` (with file_path) asks for some of the files; the
    others still give definitions, macros and include targets.
    """
    plan = plan or plan_reading(files, scratch)
    own = files if only is None else files.join(only.select("file_path"), "file_path", "left_semi")
    dynamic = own.filter(extract.has_dynamic_deps(F.col("code"))).select("file_path", "code")
    calling = own.join(plan.called, "file_path", "left_semi").filter(~extract.has_dynamic_deps(F.col("code"))).select("file_path", "code")
    wanted = dynamic.unionByName(calling)
    wanted = wanted.filter(F.col("file_path").isNotNull())
    columns = ("file_path", "text", "total", "open", "definitions")
    read = plan.scratch.save(_read(wanted, plan.included, plan.called).select(*columns, "code"), "read")
    if read.groupBy("file_path").count().filter("count > 1").limit(1).count():
        # Rows of one path are told apart by nothing: each text as read stands for each of them.
        read = plan.scratch.save(read.select(*columns).join(read.select("file_path", "code"), "file_path"), "read")
    return Resolution(read, plan.links.select("file_path", "include_file", "candidate", "resolved_path").distinct())


def resolved_dependencies(
    files: DataFrame,
    options: ParseOptions = ParseOptions(),
    loaded_at: Column | None = None,
    resolution: Resolution | None = None,
) -> DataFrame:
    """Inputs and outputs of programs after substitution.

    A reference takes the latest definition above it: the program's own, one an
    include above brought, or a parameter of the macro it stands in; a name
    without any above takes the first below. Macros called by the program add
    the datasets of their bodies, with the arguments of each call. The
    confidence is the share of references that were fully replaced. A dataset
    name that an open reference cuts short is left out of the resolved lists.
    """
    created = F.lit(None) if loaded_at is None else loaded_at
    judged = (resolution or read_corpus(files)).read
    total, left = F.col("total"), extract.sorted_set(F.col("open"))
    confidence = F.when(total == 0, F.lit(1.0)).otherwise((total - F.size("open")) / total)
    notes = F.when(F.size(left) > 0, F.concat(F.lit("unresolved: "), F.array_join(left, ", ")))
    side = options.proc_data_as
    return judged.select(
        "file_path",
        extract.input_datasets(F.col("code"), side).alias("original_inputs"),
        extract.output_datasets(F.col("code"), side).alias("original_outputs"),
        extract.input_datasets(F.col("text"), side, whole_names=True).alias("resolved_inputs"),
        extract.output_datasets(F.col("text"), side, whole_names=True).alias("resolved_outputs"),
        confidence.cast("float").alias("resolution_confidence"),
        F.map_from_entries("definitions").alias("macro_definitions"),
        notes.alias("resolution_notes"),
        created.cast("timestamp").alias("created_at"),
    )


def _path_keys(path: Column) -> Column:
    """Ways to look a path up, best first: as written, without scheme, by base name."""
    return F.array(
        F.struct(F.lit(1).alias("rank"), path.alias("key")),
        F.struct(F.lit(2).alias("rank"), plain_path(path).alias("key")),
        F.struct(F.lit(3).alias("rank"), base_name(path).alias("key")),
    )


def include_targets(candidates: DataFrame, paths: DataFrame) -> DataFrame:
    """(candidate, resolved_path) for candidates that stand for one known file.

    Candidates are made distinct first, so a file that everyone includes is
    looked up once. A key that several files share decides nothing; minimum and
    maximum tell that without collecting the files.
    """
    wanted = candidates.select("candidate").distinct()
    wanted = wanted.select("candidate", F.inline(_path_keys(F.col("candidate"))))
    # Written first: few keys are broadcast to the paths, and only paths that have one are grouped.
    wanted = Scratch(paths.sparkSession, "targets").save(wanted, "keys")
    known = (
        paths.select("file_path", F.inline(_path_keys(F.col("file_path"))))
        .join(wanted.select("rank", "key").distinct(), ["rank", "key"], "left_semi")
        .groupBy("rank", "key")
        .agg(F.min("file_path").alias("resolved_path"), F.max("file_path").alias("other"))
        .filter(F.col("resolved_path") == F.col("other"))
        .drop("other")
    )
    return wanted.join(known, ["rank", "key"]).groupBy("candidate").agg(F.min_by("resolved_path", "rank").alias("resolved_path"))


def include_links(raw: DataFrame, paths: DataFrame) -> DataFrame:
    """(file_path, include_file, candidate, resolved_path); null when no file fits."""
    links = raw.select("file_path", F.explode("include_files").alias("include_file")).withColumn(
        "candidate", candidate_path(F.col("file_path"), F.col("include_file"))
    )
    # Read three times below: for the targets, the count and the join.
    links = Scratch(raw.sparkSession, "links").save(links, "links")
    targets = include_targets(links, paths)
    # A common include may be the target of a large share of all links.
    hot = find_hot_keys(links, "candidate")
    return skew_join(
        links, targets, "candidate", "left", hot_left=hot, by_left=["file_path"]
    ).select("file_path", "include_file", "candidate", "resolved_path")


def expanded_includes(
    files: DataFrame, links: DataFrame, max_level: int | None = None, loaded_at: Column | None = None
) -> DataFrame:
    """Every file reached by includes from every including file.

    Breadth first, one join per level. A file is listed once per root, at its
    shortest distance; the root itself and files already listed are not
    expanded again, so include cycles end. Include texts no file fits are listed
    with a null path.
    """
    spark = files.sparkSession
    scratch = Scratch(spark, "includes")
    created = F.lit(None) if loaded_at is None else loaded_at
    links = scratch.save(links.select("file_path", "include_file", "resolved_path"), "links")
    # Unmatched texts stand for themselves, so they too are listed once per root.
    steps = links.select(
        F.col("file_path").alias("at"),
        "include_file",
        "resolved_path",
        F.coalesce("resolved_path", F.concat(F.lit("\u0000"), "include_file")).alias("to"),
    )
    hot_steps = find_hot_keys(steps, "at")

    def merged(reached: DataFrame) -> DataFrame:
        return (
            reached.filter(F.col("to") != F.col("root"))
            .groupBy("root", "to")
            .agg(
                F.min("include_file").alias("include_file"),
                F.first("resolved_path").alias("resolved_path"),
            )
        )

    found, rows = scratch.save_counted(merged(steps.withColumn("root", F.col("at"))), "level1")
    listed = found.withColumn("expansion_level", F.lit(1))
    level = 1
    with partitioned(steps, "at", hot_steps, ["to"]) as held:
        while rows and (max_level is None or level < max_level):
            level += 1
            frontier = found.filter(F.col("resolved_path").isNotNull()).select("root", F.col("to").alias("at"))
            hot = find_hot_keys(frontier, "at")
            reached = merged(held.join(frontier, hot, ["root"]))
            new = reached.join(listed.select("root", "to"), ["root", "to"], "left_anti")
            found, rows = scratch.save_counted(new, f"level{level}")
            if rows:
                listed = listed.unionByName(found.withColumn("expansion_level", F.lit(level)))
    listed = listed.select(
        F.col("root").alias("file_path"), "include_file", "resolved_path", "expansion_level"
    )
    # Program texts join last, once; only rows with a path take part, so that
    # rows without one do not meet in a single task.
    matched = listed.filter(F.col("resolved_path").isNotNull())
    texts = files.select(F.col("file_path").alias("resolved_path"), F.col("code").alias("include_content"))
    hot = find_hot_keys(matched, "resolved_path")
    with_text = skew_join(
        matched, texts, "resolved_path", "left", hot_left=hot, by_left=["file_path"]
    )
    without = listed.filter(F.col("resolved_path").isNull()).withColumn(
        "include_content", F.lit(None).cast("string")
    )
    return with_text.unionByName(without).select(
        "file_path",
        "include_file",
        "resolved_path",
        "include_content",
        "expansion_level",
        created.cast("timestamp").alias("created_at"),
    )
