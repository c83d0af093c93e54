"""Business classification and catalogue matching of datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from threadline.plans.scratch import Scratch
from threadline.plans.skew import find_hot_keys, skew_join

_RULE = ("priority", "pattern", "business_domain", "data_category", "sensitivity_level")


_GRAM = 3
# Rules a task may hold: up to so many they are broadcast, beyond both sides are shuffled.
_BROADCAST_RULES = 50_000


def _grams(text: Column) -> Column:
    """The distinct three-character pieces of a text."""
    long = F.length(text) >= _GRAM
    pieces = F.transform(F.sequence(F.lit(1), F.length(text) - _GRAM + 1), lambda i: F.substr(text, i, F.lit(_GRAM)))
    return F.array_distinct(F.when(long, pieces).otherwise(F.array().cast("array<string>")))


def _literals(pattern: Column) -> Column:
    """The texts between the wildcards of a LIKE pattern."""
    found = F.regexp_extract_all(pattern, F.lit(r"((?:[^%_\\]|\\.)+)"), F.lit(1))
    return F.transform(found, lambda t: F.regexp_replace(t, r"\\(.)", "$1"))


def _candidates(names: DataFrame, rules: DataFrame, scratch: Scratch) -> DataFrame:
    """Names with the rules that may fit: those whose rarest literal piece the name holds.

    A LIKE pattern fits only names that hold all its literal texts, so names meet
    rules by an equi-join on one piece of three characters, the one that fewest
    names hold. Pieces that belong to no rule are dropped before anything moves.
    Rules without such a piece (``%``, ``a%``) meet every name.
    """
    rules, n_rules = scratch.save_counted(
        rules.select(*_RULE, F.array_distinct(F.flatten(F.transform(_literals(F.col("pattern")), _grams))).alias("grams")), "rules"
    )
    small = (lambda df: F.broadcast(df)) if n_rules <= _BROADCAST_RULES else (lambda df: df)
    pieces = rules.select(F.explode("grams").alias("gram")).distinct()
    held = names.select("dataset_name", F.explode(_grams(F.col("dataset_name"))).alias("gram")).join(small(pieces), "gram")
    counts = scratch.save(held.groupBy("gram").agg(F.count("*").alias("names")), "counts")
    ranked = rules.select(*_RULE, F.explode("grams").alias("gram")).join(counts, "gram", "left")
    # A piece that no name holds leaves its rule without names.
    keyed = ranked.groupBy(*_RULE).agg(F.min(F.struct(F.coalesce("names", F.lit(0)).alias("names"), "gram")).alias("key"))
    keyed = scratch.save(keyed.filter("key.names > 0").select(*_RULE, F.col("key.gram").alias("gram")), "keyed")
    wanted = held.join(small(keyed.select("gram").distinct()), "gram", "left_semi")
    if n_rules <= _BROADCAST_RULES:
        met = wanted.join(F.broadcast(keyed), "gram")
    else:
        met = skew_join(wanted, keyed, "gram", hot_left=find_hot_keys(wanted, "gram"), by_left=["dataset_name"])
    free = rules.filter(F.size("grams") == 0).select(F.lit("").alias("gram"), *_RULE)
    every = names.select("dataset_name", F.lit("").alias("gram"))
    return met.select("dataset_name", *_RULE).unionByName(every.join(small(free), "gram").select("dataset_name", *_RULE))


def classify_datasets(datasets: DataFrame, rules: DataFrame) -> DataFrame:
    """Domain, category and sensitivity from the matching rule of best priority.

    Ties in priority go to the smaller pattern; a name no rule fits keeps nulls.
    """
    scratch = Scratch(datasets.sparkSession, "classify")
    names = scratch.save(datasets.select("dataset_name").distinct(), "names")
    fitting = _candidates(names, rules, scratch).filter(F.expr("dataset_name LIKE pattern"))
    unfit = names.select("dataset_name", *[F.lit(None).cast(rules.schema[c].dataType).alias(c) for c in _RULE])
    best = F.min_by(F.struct(*_RULE[2:]), F.when(F.col("pattern").isNotNull(), F.struct("priority", "pattern")))
    found = fitting.select("dataset_name", *_RULE).unionByName(unfit)
    labels = ["business_domain", "data_category", "sensitivity_level"]
    described = F.when(
        F.col("business_domain").isNotNull(),
        F.concat(F.col("business_domain"), F.lit(" / "), F.col("data_category"), F.lit(" / "), F.col("sensitivity_level")),
    )
    return (
        found.groupBy("dataset_name")
        .agg(best.alias("best"))
        .select("dataset_name", *[F.col(f"best.{c}").alias(c) for c in labels])
        .withColumn("description", described)
    )


# Stands for one substituted character in an edit key; not part of any name.
_ANY = "\u0001"


def _positions(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>"))


def _without(text: Column, i: Column) -> Column:
    return F.concat(F.left(text, i - 1), F.substr(text, i + 1))


def _masked(text: Column, i: Column) -> Column:
    return F.concat(F.left(text, i - 1), F.lit(_ANY), F.substr(text, i + 1))


def _each(texts: Column, change) -> Column:
    """Every one-step change of every text, without repeats."""
    changed = F.transform(texts, lambda t: F.transform(_positions(t), lambda i: change(t, i)))
    return F.array_distinct(F.flatten(changed))


def _edit_keys(name: Column, edits: int, catalog_side: bool) -> Column:
    """Texts both names share exactly when at most ``edits`` edits lie between them.

    A substitution masks one character on both sides, an insertion drops one on
    the catalogue side, a deletion drops one on the dataset side. Each mix of
    edits has its own tag, so equal keys mean equal cost.
    """
    itself = F.array(name)
    masked = _each(itself, _masked)
    dropped = _each(itself, _without)
    if edits == 1:
        tagged = {"S": masked, "I": dropped if catalog_side else itself, "D": itself if catalog_side else dropped}
    else:
        dropped_twice = _each(dropped, _without)
        dropped_masked = _each(dropped, _masked)
        tagged = {
            "SS": _each(masked, _masked),
            "SI": dropped_masked if catalog_side else masked,
            "SD": masked if catalog_side else dropped_masked,
            "II": dropped_twice if catalog_side else itself,
            "DD": itself if catalog_side else dropped_twice,
            "ID": dropped,
        }
    return F.concat(*[_tagged(tag, keys) for tag, keys in tagged.items()])


def _tagged(tag: str, keys: Column) -> Column:
    return F.transform(keys, lambda k: F.concat(F.lit(f"{tag}:"), k))


def _piece_keys(text: str, length: str, edits: int) -> str:
    """Keys (length, piece number, piece) of the table names near ``text``.

    A table name of ``length`` is cut into ``edits + 1`` pieces. Edits can touch
    all but one, and the one left appears in the other name, moved by at most
    ``edits`` places.
    """
    cut = f"(i * l div {edits + 1})"
    end = f"((i + 1) * l div {edits + 1})"
    fits = f"filter(sequence(-{edits}, {edits}), s -> {cut} + s >= 0 AND {end} + s <= length({text}))"
    piece = f"substr({text}, int({cut} + s + 1), int({end} - {cut}))"
    per_length = (
        f"flatten(transform(sequence(0, {edits}), i -> "
        f"transform({fits}, s -> concat(l, ':', i, ':', {piece}))))"
    )
    return f"array_distinct(flatten(transform({length}, l -> {per_length})))"


def _near_pieces(
    names: DataFrame, tables: DataFrame, edits: int, scratch: Scratch
) -> tuple[DataFrame, DataFrame]:
    """Names and tables that share an untouched piece with the other side.

    A superset of those within ``edits`` of each other. Pieces are made distinct
    before they meet, so a common one is one row and no pairs are formed.
    """
    # On the table side the piece stands where it was cut.
    own = F.expr(
        f"transform(sequence(0, {edits}), i -> concat(length(table_name), ':', i, ':', "
        f"substr(table_name, int((i * length(table_name) div {edits + 1}) + 1), "
        f"int(((i + 1) * length(table_name) div {edits + 1}) - (i * length(table_name) div {edits + 1})))))"
    )
    lengths = f"sequence(greatest(length(dataset_name) - {edits}, 0), length(dataset_name) + {edits})"
    probe = F.expr(_piece_keys("dataset_name", lengths, edits))
    pieces = tables.select("table_name", F.explode(own).alias("key"))
    probes = names.select("dataset_name", F.explode(probe).alias("key"))
    return (
        scratch.save(
            probes.join(pieces.select("key").distinct(), "key", "left_semi").select("dataset_name").distinct(), "names"
        ),
        scratch.save(
            pieces.join(probes.select("key").distinct(), "key", "left_semi").select("table_name").distinct(), "tables"
        ),
    )


def _shape(name: str) -> Column:
    return F.translate(name, "0123456789", "").alias("shape")


def _near_shapes(
    names: DataFrame, tables: DataFrame, edits: int, scratch: Scratch
) -> tuple[DataFrame, DataFrame]:
    """Names and tables whose text without digits is within ``edits`` of the other side's.

    Leaving characters of one kind out of both names never adds edits, so no
    match is lost. Numbered names share few shapes, which makes this a small
    join; where shapes are about as many as names it would not help and is
    skipped.
    """
    left, n_names = scratch.save_counted(names.select("dataset_name", _shape("dataset_name")), "shaped")
    right, n_tables = scratch.save_counted(tables.select("table_name", _shape("table_name")), "shaped")
    left_shapes, n_left = scratch.save_counted(left.select("shape").distinct(), "shapes")
    right_shapes, n_right = scratch.save_counted(right.select("shape").distinct(), "shapes")
    if 2 * (n_left + n_right) > n_names + n_tables:
        return names, tables

    def keyed(shapes: DataFrame, catalog_side: bool) -> DataFrame:
        levels = [_tagged("", F.array(F.col("shape")))]
        levels += [_edit_keys(F.col("shape"), e, catalog_side) for e in range(1, edits + 1)]
        return scratch.save(shapes.select("shape", F.explode(F.concat(*levels)).alias("key")), "shapekeys")

    left_keys, right_keys = keyed(left_shapes, False), keyed(right_shapes, True)

    def kept(side: DataFrame, total: int, mine: DataFrame, other: DataFrame, column: str) -> DataFrame:
        near = mine.join(other.select("key").distinct(), "key", "left_semi").select("shape").distinct()
        hot = find_hot_keys(side, "shape", total=total)
        return scratch.save(
            skew_join(side, near, "shape", "left_semi", hot_left=hot, by_left=[column]).select(column), "near"
        )

    return (
        kept(left, n_names, left_keys, right_keys, "dataset_name"),
        kept(right, n_tables, right_keys, left_keys, "table_name"),
    )


# Rounding of quotients must not shut out a pair; the confidence itself is compared exactly at the end.
_SLACK = 1e-9


# Up to so many edits the match with fewest edits has the best ratio as well.
_LOW = 1


def _allowed(left: str, right: str, share: float) -> str:
    """Edits within a share of the longer length."""
    return f"int(floor(greatest({left}, {right}) * {share!r}D + {_SLACK!r}D))"


def _meet(
    names: DataFrame, tables: DataFrame, share: float, scratch: Scratch
) -> DataFrame:
    """A superset of the pairs whose edits are within the share of the longer length.

    Both sides have an ``id``, a ``text`` and a ``size``, the length that the share
    refers to. The table's text is cut into one piece more than the edits allowed
    for a pair of sizes. Some piece i is then whole, with i edits before it and no
    more than the others behind it, so the name has it moved by at most i places
    from the left and by at most the others from the right. A pair comes once per
    piece it shares.
    """
    spans = [tuple(r) for r in (side.agg(F.min("size"), F.max("size")).first() for side in (names, tables))]
    if any(s[0] is None for s in spans):
        return names.select(F.col("id").alias("name_id")).crossJoin(tables.select(F.col("id").alias("table_id"))).limit(0)
    keep = 1 - share
    (least_n, most_n), (least_m, most_m) = spans

    def sizes(own: str, least: int, most: int) -> str:
        """Sizes of the other side within the share."""
        upper = f"least({most}, int(ceil({own} / {keep!r}D)) + 1)" if keep > 0 else f"{most}"
        lower = f"greatest({least}, int(floor({own} * {keep!r}D)) - 1)"
        k = _allowed(own, "o", share)
        spread = f"CASE WHEN {lower} <= {upper} THEN sequence({lower}, {upper}) ELSE array() END"
        return f"filter({spread}, o -> abs({own} - o) <= {k} AND {k} > {_LOW})"

    cut = "int(i * l div (k + 1))"
    end = "int((i + 1) * l div (k + 1))"
    owned = tables.withColumn("sizes", F.expr(sizes("size", least_n, most_n))).select(
        F.col("id").alias("table_id"),
        "text",
        F.length("text").alias("l"),
        "size",
        F.explode(F.expr(f"array_distinct(transform(sizes, o -> {_allowed('size', 'o', share)}))")).alias("k"),
    )
    pieces = owned.select(
        "table_id", "text", "size", "l", "k", F.explode(F.expr("sequence(0, k)")).alias("i")
    ).select("table_id", F.expr(f"concat_ws(':', size, l, k, i, substr(text, {cut} + 1, {end} - {cut}))").alias("key"))
    # Texts may be shorter than sizes; their lengths differ by kind of the text.
    lengths = scratch.save(tables.select(F.col("size").alias("o"), F.length("text").alias("l")).distinct(), "lengths")
    probing = (
        names.select("id", "text", "size", F.explode(F.expr(sizes("size", least_m, most_m))).alias("o"))
        .join(lengths, "o")
        .select("id", "text", "o", "l", F.expr(_allowed("size", "o", share)).alias("k"))
        .select("*", F.explode(F.expr("sequence(0, k)")).alias("i"))
    )
    moved = "length(text) - l"
    fits = (
        f"filter(sequence(-i, i), s -> abs({moved} - s) <= k - i AND {cut} + s >= 0 AND {end} + s <= length(text))"
    )
    probes = probing.select(
        F.col("id").alias("name_id"),
        F.explode(F.expr(
            f"array_distinct(transform({fits}, s -> concat_ws(':', o, l, k, i, substr(text, {cut} + s + 1, {end} - {cut}))))"
        )).alias("key"),
    )
    pieces, n_pieces = scratch.save_counted(pieces, "pieces")
    # What no table has is left out before anything is counted or moved.
    probes, n_probes = scratch.save_counted(
        probes.join(pieces.select("key").distinct(), "key", "left_semi"), "probes"
    )
    return skew_join(
        probes,
        pieces,
        "key",
        hot_left=find_hot_keys(probes, "key", total=n_probes),
        hot_right=find_hot_keys(pieces, "key", total=n_pieces),
        by_left=["name_id"],
        by_right=["table_id"],
    ).select("name_id", "table_id")


def _within_share(
    names: DataFrame, tables: DataFrame, share: float, scratch: Scratch
) -> DataFrame:
    """Best table (least edits per length, then name) of each name.

    Texts without digits meet first, one row per text and length, because leaving
    characters of one kind out never adds edits. Only what is near there is cut
    into pieces with its digits.
    """
    left = scratch.save(names.select("dataset_name", _shape("dataset_name"), F.length("dataset_name").alias("size")), "left")
    right = scratch.save(tables.select("table_name", _shape("table_name"), F.length("table_name").alias("size")), "right")

    def shapes(side: DataFrame) -> DataFrame:
        kinds = side.select("shape", "size").distinct()
        return scratch.save(kinds.select(F.struct("shape", "size").alias("id"), F.col("shape").alias("text"), "size"), "kinds")

    kinds = _meet(shapes(left), shapes(right), share, scratch)
    allowed = _allowed("name_id.size", "table_id.size", share)
    near = scratch.save(
        kinds.filter(F.expr(f"levenshtein(name_id.shape, table_id.shape, {allowed}) >= 0")).distinct(), "nearkinds"
    )

    def kept(side: DataFrame, kind: str, name: str) -> DataFrame:
        mine = near.select(f"{kind}.shape", f"{kind}.size").distinct()
        # Kinds are few against names, or about one name has each: the kind with its size is no hot key of the join.
        found = side.withColumn("kind", F.concat_ws(":", "size", "shape"))
        hot = find_hot_keys(found, "kind")
        found = skew_join(
            found, mine.select(F.concat_ws(":", "size", "shape").alias("kind")), "kind", "left_semi",
            hot_left=hot, by_left=[name],
        )
        return scratch.save(found.select(F.col(name).alias("id"), F.col(name).alias("text"), "size"), "close")

    pairs = _meet(kept(left, "name_id", "dataset_name"), kept(right, "table_id", "table_name"), share, scratch)
    allowed = _allowed("length(name_id)", "length(table_id)", share)
    return (
        pairs.withColumn("edits", F.expr(f"levenshtein(name_id, table_id, {allowed})"))
        .filter("edits >= 0")
        .groupBy(F.col("name_id").alias("dataset_name"))
        .agg(F.min(_rank("name_id", "table_id")).alias("found"))
    )


def _rank(name: str, table: str) -> Column:
    """Orders matches: the best ratio first, then the smaller name."""
    longest = F.greatest(F.length(name), F.length(table), F.lit(1))
    return F.struct(
        (F.col("edits") / longest).alias("share"), F.col(table).alias("table_name"), F.col("edits").cast("int").alias("edits")
    )


def _match_by_share(best: DataFrame, tables: DataFrame, min_confidence: float, scratch: Scratch) -> DataFrame:
    """Matches at any number of edits that the confidence admits.

    ``best`` has a row per name with its match so far or nulls. A name keeps it
    when no table further away could be as good: at e edits the ratio is at best
    1 - e / (length + e).
    """
    share = 1 - min_confidence
    longest = F.lit(tables.agg(F.max(F.length("table_name"))).first()[0]).cast("int")
    length = F.length("dataset_name")
    next_share = F.lit(_LOW + 1) / (length + _LOW + 1)
    so_far = F.col("edits") / F.greatest(length, F.length("table_name"), F.lit(1))
    could = (
        longest.isNotNull()
        & (next_share <= share + _SLACK)
        & (F.greatest(length, longest) * share + _SLACK >= _LOW + 1)
        & (F.col("edits").isNull() | (next_share <= so_far + _SLACK))
    )
    could = F.coalesce(could, F.lit(False))
    still, n = scratch.save_counted(best.filter(could), "open")
    if n == 0:
        return best
    found = _within_share(still.select("dataset_name"), tables, share, scratch)
    before = F.when(F.col("table_name").isNotNull(), _rank("dataset_name", "table_name"))
    chosen = F.least(before, F.col("found"))
    wider = still.join(found, "dataset_name", "left").select("dataset_name", chosen.alias("m"))
    return best.filter(~could).unionByName(
        scratch.save(wider.select("dataset_name", "m.table_name", "m.edits"), "wider")
    )


def match_catalog(
    datasets: DataFrame, catalog: DataFrame, max_edits: int | None = None, min_confidence: float = 0.7
) -> DataFrame:
    """Best catalogue table per dataset: highest confidence, then name.

    Confidence is 1 - edits / length of the longer name, and what it admits
    decides how many edits a match may have; ``max_edits`` (0, 1 or 2) asks for
    fewer, and then fewest edits come before confidence. Equal names match
    first. Up to two edits meet through edit keys, an exact blocking: the
    catalogue keeps one (the smallest) table name per key, because all names
    behind a key are equally far away, so a crowded neighbourhood costs one row
    per key and no pairs. Names far from every table are set aside before keys
    are formed, and names matched at one edit do not enter the second step.
    Names for which more edits could do better meet the tables by whole pieces,
    and every pair is checked.
    """
    by_share = max_edits is None
    if by_share:
        max_edits = 2
    if max_edits not in (0, 1, 2):
        raise ValueError("max_edits must be 0, 1 or 2, or None for what min_confidence admits")
    scratch = Scratch(datasets.sparkSession, "match")
    names = scratch.save(datasets.select("dataset_name").distinct(), "names")
    tables = scratch.save(catalog.select("table_name").distinct(), "tables")
    step = names.join(tables.withColumn("dataset_name", F.col("table_name")), "dataset_name", "left")
    matches: list[DataFrame] = []
    far: list[DataFrame] = []
    for edits in range(max_edits + 1):
        if edits == 1:
            near, near_tables = _near_shapes(rest, tables, max_edits, scratch)
            near, near_tables = _near_pieces(near, near_tables, max_edits, scratch)
            far.append(rest.join(near, "dataset_name", "left_anti"))
            rest = near
        if edits:
            keyed = near_tables.select("table_name", F.explode(_edit_keys(F.col("table_name"), edits, True)).alias("key"))
            nearest = keyed.groupBy("key").agg(F.min("table_name").alias("table_name"))
            best = F.max_by("table_name", F.length("table_name"))
            found = (
                rest.select("dataset_name", F.explode(_edit_keys(F.col("dataset_name"), edits, False)).alias("key"))
                .join(nearest, "key")
                .groupBy("dataset_name", F.length("table_name").alias("n"))
                .agg(F.min("table_name").alias("table_name"))
                .groupBy("dataset_name")
                .agg(best.alias("table_name"))
            )
            step = rest.join(found, "dataset_name", "left")
        step = scratch.save(step.select("dataset_name", "table_name"), f"edits{edits}")
        matches.append(step.filter(F.col("table_name").isNotNull()).withColumn("edits", F.lit(edits)))
        rest = step.filter(F.col("table_name").isNull()).select("dataset_name")
    matched = reduce(DataFrame.unionByName, matches)
    unmatched = reduce(DataFrame.unionByName, far, rest).select(
        "dataset_name", F.lit(None).cast("string").alias("table_name"), F.lit(None).cast("int").alias("edits")
    )
    best = matched.unionByName(unmatched)
    if by_share:
        best = _match_by_share(scratch.save(best, "near"), tables, min_confidence, scratch)
    longest = F.greatest(F.length("dataset_name"), F.length("table_name"), F.lit(1))
    confidence = 1.0 - F.col("edits") / longest
    good = confidence >= min_confidence
    return best.select(
        "dataset_name",
        F.when(good, F.col("table_name")).alias("unity_catalog_match"),
        F.when(good, confidence).alias("match_confidence"),
    )


def dataset_classifications(
    classes: DataFrame, matches: DataFrame, loaded_at: Column | None = None
) -> DataFrame:
    """The ``dataset_classifications`` table."""
    created = F.lit(None) if loaded_at is None else loaded_at
    return classes.join(matches, "dataset_name", "left").select(
        "dataset_name",
        "business_domain",
        "data_category",
        "sensitivity_level",
        "description",
        "unity_catalog_match",
        F.col("match_confidence").cast("float").alias("match_confidence"),
        created.cast("timestamp").alias("created_at"),
    )
