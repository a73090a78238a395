"""Event logs folded to current state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarmill.constants import FIELDS
from scholarmill.functions.literals import constant_map
from scholarmill.operators.positions import before, sorted_slices
from scholarmill.operators.taxonomy import constant_relation

KEYS = ["session", "field"]


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of every key. ``max_by`` combines on the map side, so a hot key shrinks to one
    row per task before it is shuffled; a row_number window would not."""
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_newest.*")


# Each sub-field of a field has one bit. A field has at most twelve.


def _bit_lookup() -> Column:
    """Map of field to a map of sub-field to bit."""
    return constant_map(
        [(field, [(n, 1 << i) for i, n in enumerate(names)]) for field, names in FIELDS.items()]
    )


def _all_bits() -> Column:
    full = constant_map([(field, (1 << len(names)) - 1) for field, names in FIELDS.items()])
    return full[F.col("field")]


def known_toggles(events: DataFrame) -> DataFrame:
    """Toggles of listed fields and sub-fields with ``cut`` (1 for a field toggle) and ``bit``.

    Nothing else can be pressed, so other names are dropped by the join with the constant list.
    """
    rows = [(field, "", 0) for field in FIELDS]
    rows += [(f, name, 1 << i) for f, names in FIELDS.items() for i, name in enumerate(names)]
    bits = constant_relation(
        events.sparkSession, rows, "field string, pressed string, bit bigint"
    )
    is_field = F.col("kind") == "field"
    pressed = F.when(is_field, "").otherwise(F.nullif(F.col("sub_field"), F.lit("")))
    return (
        events.withColumn("pressed", pressed)
        .withColumn("cut", is_field.cast("bigint"))
        .join(F.broadcast(bits), ["field", "pressed"])
    )


def fold_selection(
    events: DataFrame, order: tuple[str, ...] = ("ord",), stored_as: str | None = None
) -> DataFrame:
    """Current selection per (session, field) from a log of toggles (session, ord, kind, field,
    sub_field), where ``kind`` is 'field' or 'sub' and ``order`` is unique in a session.

    A field toggle switches an enabled field off and clears it, or a disabled one on with all its
    sub-fields. A sub-field toggle flips that sub-field, and when none is left the field goes off; it
    never switches a field on.

    The log is not replayed event by event. Field toggles cut it into intervals. Inside one, the
    selected set is the set at its start XOR the sub-fields flipped since, so running XORs give every
    intermediate set. An interval that starts full and reaches the empty set, or one that starts
    disabled, is followed by "on"; any other is followed by the opposite of how it began. So the
    state depends on the last emptied interval and on the number of intervals since. Running values
    are taken per slice of the sorted log and carried over as one row per slice, so one session may
    hold any share of the log.
    """
    toggles = known_toggles(events).select(*KEYS, *order, "cut", "bit")
    rows = sorted_slices(toggles, KEYS, [F.col(c) for c in order], stored_as)

    totals = rows.groupBy(*KEYS, "_slice").agg(
        F.sum("cut").alias("cuts"), F.bit_xor("bit").alias("flips")
    )
    # What came before a slice enters it as one more row in front, so no join is needed.
    earlier = before(KEYS)
    carried = totals.select(
        *KEYS,
        "_slice",
        F.lit(-1).cast("bigint").alias("_row"),
        F.coalesce(F.sum("cuts").over(earlier), F.lit(0)).alias("cut"),
        F.coalesce(F.bit_xor("flips").over(earlier), F.lit(0)).alias("bit"),
        F.sum("cuts").over(Window.partitionBy(*KEYS)).alias("n_cuts"),
    )
    running = (
        Window.partitionBy(*KEYS, "_slice")
        .orderBy("_row")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = (
        rows.select(*KEYS, "_slice", "_row", "cut", "bit")
        .unionByName(carried, allowMissingColumns=True)
        .select(
            *KEYS,
            "_row",
            "cut",
            F.max("n_cuts").over(running).alias("n_cuts"),
            F.sum("cut").over(running).alias("interval"),
            F.bit_xor("bit").over(running).alias("flips"),
        )
        .where(F.col("_row") >= 0)
    )

    # A set of running XORs holds at most one value per subset of the field's sub-fields.
    intervals = (
        placed.groupBy(*KEYS, "interval")
        .agg(
            F.max("n_cuts").alias("n_cuts"),
            F.coalesce(F.max(F.when(F.col("cut") == 1, F.col("flips"))), F.lit(0)).alias("start"),
            F.collect_set(F.when(F.col("cut") == 0, F.col("flips"))).alias("seen"),
            F.max_by("flips", "_row").alias("end"),
        )
        .select(
            *KEYS,
            "interval",
            "n_cuts",
            F.col("start").bitwiseXOR(F.col("end")).alias("flipped"),
            (
                (F.col("interval") > 0)
                & F.array_contains("seen", F.col("start").bitwiseXOR(_all_bits()))
            ).alias("emptied"),
        )
    )
    is_last = F.col("interval") == F.col("n_cuts")
    folded = intervals.groupBy(*KEYS).agg(
        F.max("n_cuts").alias("n_cuts"),
        F.max(F.when(is_last, F.col("flipped"))).alias("flipped"),
        F.max(F.when(is_last, F.col("emptied"))).alias("emptied"),
        F.coalesce(F.max(F.when(~is_last & F.col("emptied"), F.col("interval") + 1)), F.lit(1)).alias(
            "restart"
        ),
    )
    on_after_cut = (F.col("n_cuts") > 0) & ((F.col("n_cuts") - F.col("restart")) % 2 == 0)
    at_cut = F.when(on_after_cut, _all_bits()).otherwise(F.lit(0).cast("bigint"))
    return folded.select(
        *KEYS,
        (on_after_cut & ~F.col("emptied")).alias("enabled"),
        at_cut.bitwiseXOR(F.col("flipped")).alias("selected"),
    )


def sub_fields_of(selected: Column) -> Column:
    """Names of the bits set, sorted."""
    names = F.map_filter(
        _bit_lookup()[F.col("field")], lambda _, bit: selected.bitwiseAND(bit) != 0
    )
    return F.array_sort(F.map_keys(names))


def as_toggles(state: DataFrame) -> DataFrame:
    """The shortest log that leads to ``state``: a field toggle if enabled, then single sub-fields.

    Lets later toggles be folded on top of stored state: the orders are below any that a log has.
    """
    full = _bit_lookup()[F.col("field")]
    flipped = F.map_filter(
        full,
        lambda _, bit: F.when(
            F.col("enabled"), F.col("selected").bitwiseAND(bit) == 0
        ).otherwise(F.col("selected").bitwiseAND(bit) != 0),
    )
    field_press = F.when(
        F.col("enabled"),
        F.array(F.struct(F.lit("field").alias("kind"), F.lit(None).cast("string").alias("sub_field"))),
    ).otherwise(F.array().cast("array<struct<kind:string,sub_field:string>>"))
    sub_presses = F.transform(
        F.map_keys(flipped), lambda n: F.struct(F.lit("sub").alias("kind"), n.alias("sub_field"))
    )
    return state.select(
        *KEYS, F.posexplode(F.concat(field_press, sub_presses)).alias("_pos", "_press")
    ).select(
        "session",
        (F.col("_pos") + F.lit(-(1 << 63))).cast("bigint").alias("ord"),
        "_press.kind",
        "field",
        "_press.sub_field",
    )
