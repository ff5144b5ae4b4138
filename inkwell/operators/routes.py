"""Attributing requests to routes."""

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkwell.functions.urls import KINDS, build_url, path_regex, placeholders
from inkwell.sources.tables import load_inline_rows


class Route(NamedTuple):
    pattern: str
    endpoint: str
    methods: tuple[str, ...] = ("GET",)

    @property
    def answered(self) -> set[str]:
        """HEAD goes with GET, and OPTIONS is always answered."""
        implied = {"HEAD"} if "GET" in self.methods else set()
        return {*self.methods, "OPTIONS"} | implied


FORM = ("GET", "POST")

# The routes of each of the four sites, in the order they are declared.
STATIC = Route("/static/<path:filename>", "static")
BLOG_ROUTES = [
    STATIC,
    Route("/", "blog.index"),
    Route("/", "index"),
    Route("/auth/register", "auth.register", FORM),
    Route("/auth/login", "auth.login", FORM),
    Route("/auth/logout", "auth.logout"),
    Route("/create", "blog.create", FORM),
    Route("/<int:id>/update", "blog.update", FORM),
    Route("/<int:id>/delete", "blog.delete", ("POST",)),
]
UPLOAD_ROUTES = [
    STATIC,
    Route("/to_upload", "to_upload"),
    Route("/", "to_upload"),
    Route("/upload", "upload_file", FORM),
    Route("/hello/<name>", "hello"),
]
SIGN_IN_ROUTES = [
    STATIC,
    Route("/", "index"),
    Route("/login", "login", FORM),
]
PROFILE_ROUTES = [
    STATIC,
    Route("/", "index"),
    Route("/login", "login"),
    Route("/user/<username>", "profile"),
]


def url_for(routes: Sequence[Route], endpoint: str, params: Mapping[str, Column]) -> Column:
    """URL of the first route to `endpoint` whose placeholders all have a value."""
    for route in routes:
        needed = {name for name, _ in placeholders(route.pattern)}
        if route.endpoint == endpoint and needed <= set(params):
            return build_url(route.pattern, params)
    raise ValueError(f"no route to {endpoint} with {sorted(params)}")


def _ranked(routes: Sequence[Route]) -> list[Route]:
    """Routes without placeholders first, others in declared order."""
    return sorted(routes, key=lambda route: len(placeholders(route.pattern)))


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__or__, conditions, F.lit(False))


def route_match(requests: DataFrame, routes: Sequence[Route]) -> DataFrame:
    """Add `endpoint` and `status` to requests with a path and a method.

    200 and the endpoint of the first route that takes both, else 405 if a route takes
    the path, else 404. Routes without placeholders go first, others in declared order.
    The route table is part of the program, so it becomes one expression per row: no
    join and no shuffle.
    """
    ranked = _ranked(routes)
    fits = []
    for route in ranked:
        if placeholders(route.pattern):
            fits.append(F.col("path").rlike(path_regex(route.pattern)))
        else:
            fits.append(F.col("path") == route.pattern)
    endpoint = F.coalesce(
        F.lit(None).cast("string"),
        *[
            F.when(fit & F.col("method").isin(*sorted(route.answered)), route.endpoint)
            for route, fit in zip(ranked, fits)
        ],
    )
    return requests.withColumn("endpoint", endpoint).withColumn(
        "status",
        F.when(F.col("endpoint").isNotNull(), 200).when(_any(fits), 405).otherwise(404),
    )


EDGES = "parent string, step string, child string"
ENDS = "node string, rank int, endpoint string, answered array<string>"


def _steps(pattern: str) -> list[str]:
    """A pattern as steps down the tree of segments: `=` and a literal segment, or the kind of a placeholder."""
    steps = []
    for segment in pattern.split("/"):
        found = placeholders(segment)
        if found and not re.fullmatch(r"<(\w+:)?\w+>", segment):
            raise ValueError(f"a placeholder must be a whole segment: {pattern}")
        steps.append(f"<{found[0][1]}>" if found else f"={segment}")
    if "<path>" in steps[:-1]:
        raise ValueError(f"nothing can follow a path: {pattern}")
    return steps


def route_tables(spark: SparkSession, routes: Sequence[Route]) -> tuple[DataFrame, DataFrame, int]:
    """The routes as a tree of path segments: its edges, the routes that end at its nodes, and its depth."""
    edges, ends, depth = set(), [], 0
    for rank, route in enumerate(_ranked(routes)):
        steps = _steps(route.pattern)
        nodes = ["/".join(steps[:k]) for k in range(len(steps) + 1)]
        edges.update(zip(nodes, steps, nodes[1:]))
        ends.append((nodes[-1], rank, route.endpoint, sorted(route.answered)))
        depth = max(depth, len(steps))

    def table(rows: Iterable[tuple], schema: str) -> DataFrame:
        fields = StructType.fromDDL(schema)
        return load_inline_rows(spark, [dict(zip(fields.names, row)) for row in rows], fields)

    return table(sorted(edges), EDGES), table(ends, ENDS), depth


def route_match_table(requests: DataFrame, routes: Sequence[Route]) -> DataFrame:
    """The same as route_match for very many routes, whose placeholders are whole segments.

    Each distinct path walks down the tree of segments, one equi-join with the tree's edges
    per segment, so a row meets the few routes that fit it and not all of them. Then every
    request looks up the routes that fit its path.
    """
    edges, ends, depth = route_tables(requests.sparkSession, routes)
    segment, size = F.get("segments", F.col("at")), F.size("segments")
    rest = F.array_join(F.slice("segments", F.col("at") + 1, size), "/")
    ways = F.array_compact(
        F.array(
            F.concat(F.lit("="), segment),
            *[F.when(segment.rlike(f"^(?:{KINDS[kind]})\\z"), f"<{kind}>") for kind in ("int", "string")],
            F.when(rest.rlike(f"^(?:{KINDS['path']})\\z"), "<path>"),
        )
    )
    walk = requests.select("path").distinct().select(
        "path", F.split("path", "/").alias("segments"), F.lit("").alias("parent"), F.lit(0).alias("at")
    )
    for _ in range(depth):
        # A path that has ended stays where it is.
        under_way = walk.withColumn("step", F.explode(F.when(F.col("at") < size, ways).otherwise(F.array(F.lit("")))))
        passed = F.when(F.col("step") == "<path>", size).otherwise(F.least(F.col("at") + 1, size))
        walk = (
            under_way.join(edges, ["parent", "step"], "left")
            .filter((F.col("step") == "") | F.col("child").isNotNull())
            .select("path", "segments", F.coalesce("child", "parent").alias("parent"), passed.alias("at"))
        )
    fitting = (
        walk.filter(F.col("at") == size)
        .join(ends, walk["parent"] == ends["node"])
        .groupBy("path")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "endpoint", "answered"))).alias("fitting"))
    )
    answering = F.filter("fitting", lambda route: F.array_contains(route["answered"], F.col("method")))
    status = F.when(F.col("endpoint").isNotNull(), 200).when(F.col("fitting").isNotNull(), 405).otherwise(404)
    found = requests.join(fitting, "path", "left").withColumn("endpoint", F.get(answering, 0)["endpoint"])
    return found.select(*requests.columns, "endpoint", status.alias("status"))
