"""Trees of CSV files whose headers drift from file to file.

Spark takes the header of one file and applies it to all others by position. So the header of each
file is read first, files are grouped by header, each group is one read with text columns, and the
groups are united by name. Headers are few; the rows are read once.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.casts import missing_to_null
from panelcast.functions.paths import decoded, path_part, period_from_name
from panelcast.operators.conform import conform, strict_int, with_absent_as_null
from panelcast.operators.pairs import PAIR_TYPES, keep_competition, team_rows

# <season>/By Gameweek/GW<n>/<file>; a folder such as GWx does not match and is skipped.
PERIOD_PATH = r"/([^/]+)/By Gameweek/GW(\d+)/[^/]+$"
PERIOD_COLUMNS = {"season": (1, "string"), "gameweek": (2, "int")}
SEASON_PATH = r"/([^/]+)/[^/]+$"
SEASON_COLUMNS = {"season": (1, "string")}

# Quotes inside quotes are doubled, as most CSV writers do.
CSV_OPTIONS = {"header": True, "escape": '"'}


PANEL_REQUIRED = {"id": "long", "event_points": "double", "minutes": "double"}
PANEL_OPTIONAL = dict.fromkeys(
    ("expected_goals", "expected_assists", "goals_scored", "assists", "goals_conceded", "clean_sheets",
     "total_shots", "event_points_orig"), "double",
)


class EmptySource(RuntimeError):
    """No readable file was found."""


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """The paths behind a glob, also of empty files, as their folders are named. No content is read."""
    try:
        files = spark.read.format("binaryFile").load(pattern).inputFiles()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return []
        raise
    return sorted(map(unquote, files))


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file, or None if it has none. One buffer is read, however long the file is."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(conf).open(file)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def headers_of(spark: SparkSession, paths: Sequence[str], parallelism: int = 32) -> dict[tuple[str, ...], list[str]]:
    """Header to files; empty files are under the empty header.

    Like the footers of Parquet files, headers are read where the plan is made, ``parallelism`` at a
    time: a Spark task that stops after one line still reads its part of the file to the end.
    """
    with ThreadPoolExecutor(parallelism) as pool:
        lines = list(pool.map(lambda path: first_line(spark, path), paths))
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, line in zip(paths, lines, strict=True):
        names = next(csv.reader([(line or "").lstrip("\ufeff")]), [])
        groups.setdefault(tuple(name.strip() for name in names), []).append(path)
    return groups


def scan_tree(
    spark: SparkSession,
    pattern: str,
    path_pattern: str = PERIOD_PATH,
    path_columns: Mapping[str, tuple[int, str]] = PERIOD_COLUMNS,
    required: Sequence[str] = (),
    each: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """All files behind ``pattern`` as text columns, plus columns taken from the path.

    A file is skipped if its path does not match or a ``required`` column is absent. A path column
    replaces a column of the same name in the file. Columns a file lacks are null. ``each`` is applied
    to the files of one header before they are united, so it sees only columns those files have.
    Raises ``EmptySource`` when no file is left.
    """
    paths = [p for p in list_files(spark, pattern) if re.search(path_pattern, p)]
    groups = {h: files for h, files in headers_of(spark, paths).items() if h and set(required) <= set(h)}
    if not groups:
        raise EmptySource(f"no readable files behind {pattern}")
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [each(_read_group(spark, header, files, path_pattern, path_columns)) for header, files in groups.items()],
    )


def _read_text_columns(spark: SparkSession, header: Sequence[str], files: str | list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(files)


def _read_group(spark, header, files, path_pattern, path_columns) -> DataFrame:
    rows = _read_text_columns(spark, header, files)
    path = F.col("_metadata.file_path")
    return rows.select(
        *[missing_to_null(F.col(f"`{c}`")).alias(c) for c in header if c not in path_columns],
        *[path_part(path, path_pattern, group, dtype).alias(c) for c, (group, dtype) in path_columns.items()],
    )


def scan_panel(spark: SparkSession, root: str, filename: str = "player_gameweek_stats.csv") -> DataFrame:
    """Panel files of every season and period, as text."""
    return scan_tree(spark, f"{root}/*/By Gameweek/GW*/{filename}")


def load_panel(spark: SparkSession, root: str) -> DataFrame:
    """The panel with numbers as numbers; optional columns that no file has stay absent."""
    rows = conform(with_int_period(scan_panel(spark, root)), PANEL_REQUIRED)
    return conform(rows, PANEL_OPTIONAL, on_missing="drop")


def load_fixtures(spark: SparkSession, root: str, needle: str = "prem") -> DataFrame:
    """Two rows per match of the competition; which column names the competition is decided per header.

    A file needs the two team columns; without ratings its matches have null ratings.
    """
    matches = scan_tree(
        spark, f"{root}/*/By Gameweek/GW*/fixtures.csv", required=["home_team", "away_team"],
        each=lambda rows: keep_competition(rows, needle),
    )
    return team_rows(with_absent_as_null(matches, dict.fromkeys(PAIR_TYPES, "string")))


def scan_report(spark: SparkSession, pattern: str, path_pattern: str = PERIOD_PATH, required: Sequence[str] = ()) -> DataFrame:
    """``file, outcome`` of every file behind ``pattern``: read, other path, empty, or what it lacks."""
    paths = list_files(spark, pattern)
    fits = [p for p in paths if re.search(path_pattern, p)]
    rows = [(p, "other path") for p in paths if p not in set(fits)]
    for header, files in headers_of(spark, fits).items():
        absent = [c for c in required if c not in header]
        outcome = "empty" if not header else f"lacks {', '.join(absent)}" if absent else "read"
        rows += [(p, outcome) for p in files]
    return spark.createDataFrame(rows, "file string, outcome string")


def scan_season_files(spark: SparkSession, root: str, filename: str, required: Sequence[str]) -> DataFrame:
    """One file per season; files without the required columns are skipped."""
    return scan_tree(spark, f"{root}/*/{filename}", SEASON_PATH, SEASON_COLUMNS, required)


def scan_members(spark: SparkSession, root: str) -> DataFrame:
    """season, player_id, team_code, position, web_name of every season."""
    rows = scan_season_files(spark, root, "players.csv", ["player_id", "team_code"])
    spec = {"player_id": "long", "team_code": "long", "position": "string", "web_name": "string"}
    return conform(rows, spec, on_missing="null").select("season", *spec)


def scan_teams(spark: SparkSession, root: str) -> DataFrame:
    """season, team_code, team_short and defence strengths; rows without a code are dropped."""
    rows = scan_season_files(spark, root, "teams.csv", ["code", "strength_defence_home", "strength_defence_away"])
    rows = rows.withColumnsRenamed({"code": "team_code", "short_name": "team_short"})
    spec = {"team_code": "long", "team_short": "string", "strength_defence_home": "double", "strength_defence_away": "double"}
    return conform(rows, spec, on_missing="null").select("season", *spec).na.drop(subset=["team_code"])


def one_season(df: DataFrame, season: str) -> DataFrame:
    return df.where(F.col("season") == season)


def read_table(spark: SparkSession, path: str, spec: Mapping[str, str], on_missing: str = "raise") -> DataFrame:
    """One CSV table (or files with one common header) as text, conformed to ``spec``."""
    names = spark.read.options(**CSV_OPTIONS).csv(path).columns
    rows = _read_text_columns(spark, names, path)
    return conform(rows.select(*[missing_to_null(F.col(f"`{c}`")).alias(c) for c in names]), spec, on_missing)


def with_int_period(df: DataFrame, period: str = "gameweek") -> DataFrame:
    """The period as integer; the job fails on a missing one."""
    return strict_int(df, [period])


def scan_named_periods(
    spark: SparkSession,
    pattern: str,
    after: str,
    spec: Mapping[str, str],
    whole: bool = False,
    skip_others: bool = False,
    skip_incomplete: bool = False,
) -> DataFrame:
    """Files named ``gw<N><after>`` in one plan, with ``file_name`` and ``file_period``.

    Other names are left out with ``skip_others`` and stop the scan without it. In the same way,
    ``skip_incomplete`` leaves out files that lack a column of ``spec``.
    """
    start = "^" if whole else ""
    fits = re.compile(rf"{start}gw\d+{re.escape(after)}$", re.IGNORECASE)
    paths = list_files(spark, pattern)
    strangers = [p for p in paths if not fits.search(p.rsplit("/", 1)[-1])]
    if strangers and not skip_others:
        raise ValueError(f"no period in the name of {strangers[:5]}")
    groups = headers_of(spark, sorted(set(paths) - set(strangers)))
    groups.pop((), None)
    if skip_incomplete:
        groups = {header: files for header, files in groups.items() if set(spec) <= set(header)}
    if not groups:
        raise EmptySource(f"no readable files behind {pattern}")
    parts = []
    for header, files in groups.items():
        name = F.col("_metadata.file_name")
        part = _read_text_columns(spark, header, files).select(
            *[missing_to_null(F.col(f"`{c}`")).alias(c) for c in header],
            name.alias("file_name"),
            period_from_name(name, after=after, whole=whole).alias("file_period"),
        )
        parts.append(conform(part, spec, on_missing="raise"))
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
