"""From maps to labels, as one plan: what a label says of a product is aggregated from its cells, the label is a column, files are written in parallel."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlark.functions.units import metres_per_pixel
from gridlark.plans.templates import TAG, fill_column
from gridlark.schema import CHANNEL_GHZ

PRODUCT = ("orbiter", "channel", "maptype")
#: A tag that stands for a list's elements, each rendered from its own stub, a line or more.
LIST_TAG = re.compile(r"^\s*\{list:(\w+)\}\s*$")


@dataclass(frozen=True)
class LabelRules:
    """How products become labels: a template, values of its tags by name (columns of the record), conditions under which
    blocks are left out, and for each list tag its array column and the stub of an element."""

    template: str
    values: Mapping[str, Column] = field(default_factory=dict)
    left_out: Mapping[str, Column] = field(default_factory=dict)
    lists: Mapping[str, tuple[str, str]] = field(default_factory=dict)


def map_records(maps: DataFrame, per_degree: float, value: str = "value") -> DataFrame:
    """A row a product (orbiter, channel, maptype) of cells (product, bin_start, bin_stop, lat_ix, lon_ix, lat, lon, value): its size, extent, range and bins.

    bins is an array of (name, start, stop, lo, hi, missing) in order of their start. Cells are first summed by bin.
    """
    v = F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    by_bin = maps.groupBy(*PRODUCT, "bin_start", "bin_stop").agg(
        F.min(v).alias("lo"), F.max(v).alias("hi"), F.sum(F.when(v.isNull(), 1).otherwise(0)).alias("missing"), F.count(F.lit(1)).alias("cells"),
        *[f(c).alias(f"{n}_{c}") for c in ("lat_ix", "lon_ix", "lat", "lon") for n, f in (("min", F.min), ("max", F.max))],
    )
    name = F.concat_ws("_", F.upper("maptype"), F.col("bin_start").cast("string"), F.col("bin_stop").cast("string"))
    one = F.struct("bin_start", "bin_stop", name.alias("name"), "lo", "hi", "missing")
    out = by_bin.groupBy(*PRODUCT).agg(
        F.sort_array(F.collect_list(one)).alias("bins"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("cells").alias("cells"), F.sum("missing").alias("missing"),
        *[f(f"{n}_{c}").alias(f"{n}_{c}") for c in ("lat_ix", "lon_ix", "lat", "lon") for n, f in (("min", F.min), ("max", F.max))],
    )
    step = 1.0 / per_degree
    mpp = metres_per_pixel(F.lit(float(per_degree)))
    lines, samples = (F.col(f"max_{c}") - F.col(f"min_{c}") + 1 for c in ("lat_ix", "lon_ix"))
    out = out.withColumns({"lines": lines, "samples": samples, "ppd": F.lit(per_degree), "mpp": mpp, "north": F.col("max_lat") + step, "south": F.col("min_lat"), "west": F.col("min_lon"), "east": F.col("max_lon") + step})
    # the upper left pixel of a centred map, metres
    ghz = F.element_at(F.create_map(*[F.lit(x) for pair in CHANNEL_GHZ.items() for x in pair]), F.col("channel"))
    out = out.withColumns({"ul_x": -F.col("samples") / 2 * mpp, "ul_y": F.col("lines") / 2 * mpp, "channel_ghz": ghz, "n_bins": F.size("bins")})
    stem = F.lower(F.concat_ws("_", "orbiter", F.concat(F.lit("t"), F.col("channel").cast("string")), "maptype"))
    return out.withColumn("stem", stem).drop(*[f"{n}_{c}" for c in ("lat_ix", "lon_ix", "lat", "lon") for n in ("min", "max")])


def _filled(stub: str) -> Callable[[Column], Column]:
    """A list element's stub with its tags replaced by the element's fields."""
    return lambda x: fill_column(F.lit(stub), {t: x[t] for t in sorted(set(TAG.findall(stub)))})


def label_column(rules: LabelRules) -> Column:
    """The label of a record. Lines of blocks ({delete:NAME} to {stop:NAME}, not overlapping) stay unless left_out says so;
    comment lines and marks go; a null value or a tag without one raises and names the tag."""
    lines, inside = [], None
    used: dict[str, Column | None] = {}
    for line in rules.template.split("\n"):
        if mark := re.match(r"\s*\{(delete|stop):(\w+)\}", line):
            inside = mark[2] if mark[1] == "delete" and inside is None else None if mark[2] == inside else inside
            continue
        if re.match(r"\s*<!--", line):
            continue
        out = rules.left_out.get(inside, F.lit(False)) if inside else F.lit(False)
        if m := LIST_TAG.match(line):
            column, stub = rules.lists[m[1]]
            text = F.array_join(F.transform(column, _filled(stub)), "\n")
        else:
            tags = sorted(set(TAG.findall(line)))
            missing = [t for t in tags if t not in rules.values]
            if missing:
                raise KeyError(f"no rule for tags {', '.join(missing)}")
            for t in tags:
                used[t] = out if t not in used else used[t] & out
            text = fill_column(F.lit(line), {t: rules.values[t] for t in tags}) if tags else F.lit(line)
        lines.append(F.when(~out, text))
    none = [F.when(rules.values[t].isNull() & ~gone, F.lit(t)) for t, gone in sorted(used.items())]
    label = F.concat_ws("\n", *lines)
    if not none:
        return label
    names = F.concat_ws(", ", *none)
    return F.when(names != "", F.raise_error(F.concat(F.lit("no value for tags "), names)).cast("string")).otherwise(label)


def map_labels(maps: DataFrame, per_degree: float, rules: LabelRules) -> DataFrame:
    """(name, label) of every product: file names and contents, to be written by fits.write_text_files."""
    return map_records(maps, per_degree).select(F.concat(F.col("stem"), F.lit(".xml")).alias("name"), label_column(rules).alias("label"))


#: A plain label of a map product, with a block for deviations and one element a bin.
MAP_TEMPLATE = """<Product>
<!-- filled by columns -->
  <Identification><logical_id>{stem}</logical_id><orbiter>{orbiter}</orbiter><channel frequency="{channel_ghz}">{channel}</channel></Identification>
{delete:plain}
  <Deviation>biased</Deviation>
{stop:plain}
  <Extent><north>{north}</north><south>{south}</south><west>{west}</west><east>{east}</east><scale unit="m/pixel">{mpp}</scale></Extent>
  <Array><lines>{lines}</lines><samples>{samples}</samples><ul_x>{ul_x}</ul_x><ul_y>{ul_y}</ul_y></Array>
  <Bins count="{n_bins}">
{list:bins}
  </Bins>
</Product>"""
BIN_STUB = '    <Bin name="{name}"><start>{bin_start}</start><lo>{lo}</lo><hi>{hi}</hi><missing>{missing}</missing></Bin>'


def map_rules(digits: int = 3) -> LabelRules:
    """Rules of MAP_TEMPLATE: columns of map_records, numbers rounded."""
    plain = {t: F.col(t) for t in ("stem", "orbiter", "channel", "lines", "samples", "n_bins")}
    rounded = {t: F.round(F.col(t).cast("double"), digits) for t in ("channel_ghz", "north", "south", "west", "east", "mpp", "ul_x", "ul_y")}
    return LabelRules(MAP_TEMPLATE, plain | rounded, {"plain": F.col("maptype") != "STDEV"}, {"bins": ("bins", BIN_STUB)})
