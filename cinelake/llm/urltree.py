"""URL filter by host rules and path-template trees, in DataFrame operations alone.

Rules come first: the longest rule whose host is the page's host or a parent domain and
whose path starts the page's path decides.  The ruled pages are the labels of the method:

1. Every host's paths form a tree of ``DEPTH`` segments (deeper ones share one mark).
2. Under each node, a segment with less than ``RARE`` of the node's pages becomes the
   wildcard ``*`` when the node has more than ``BRANCHES`` different segments.
3. Under each node, every branch's labelled block share is tested against its siblings'
   pooled one (two proportions, continuity correction, 5 % level).  The branches that do not
   differ become one branch ``+`` before the next level is built, so what lies below them is
   counted together; branches without labels stay apart and are smoothed by their parent.
   The mark of deeper paths is tested against its template in the same way.
4. Purity, the labelled share of blocked pages, is smoothed down the tree: everywhere by
   ``WEIGHT`` pages of the parent's purity, and at a host by as many neutral ones.  Templates
   of at least ``REJECT`` are blocked; so a host without a ruled page is allowed.

Paths are first counted per (host, segments), so repeated paths and hot hosts shrink in the
map tasks; node totals are sums joined back, without a window over a host.

Defined cases: a null url, or one without ``://``, has an empty host and path and is judged
as the host '' (allow).  Repeated rows get one verdict each.  A literal segment ``*`` or
``+`` counts as the mark of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.session import materialize

DEPTH = 3
BRANCHES = 4
RARE = 0.25
WEIGHT = 4.0
REJECT = 0.8
NEUTRAL = 0.5
CHI2 = 3.84
MERGED = "+"

#: (rule, verdict): host up to the first slash, path from there.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    authority = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = rest.substr(F.length(authority) + 1, F.length(rest))
    return F.translate(authority, _UPPER, _UPPER.lower()), F.regexp_extract(after, r"^[^?#]*", 0)


def ruled(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, ruling (null where no rule fits)."""
    host, path = host_and_path(F.col("url"))
    base = pages.select("page_id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    rule, ruling = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the longest is asked first
        h, _, p = text.partition("/")
        fits = ((F.col("host") == h) | F.endswith("host", F.lit("." + h))) & F.startswith("path", F.lit("/" + p))
        rule, ruling = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(verdict)).otherwise(ruling)
    return base.withColumns({"rule": rule, "ruling": ruling})


def _segments() -> dict[str, Column]:
    cols = {f"s{k}": F.split_part("path", F.lit("/"), F.lit(k + 1)) for k in range(1, DEPTH + 1)}
    return cols | {"more": F.split_part("path", F.lit("/"), F.lit(DEPTH + 2)) != ""}


def _totals(counts: DataFrame, keys: list[str]) -> DataFrame:
    return counts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "blocked", "labelled")])


def _like_siblings() -> Column:
    """Whether a branch (blocked, labelled) of a node (pb, pl) has labelled siblings and does not
    differ from them."""
    b, l, pb, pl = (F.col(c).cast("double") for c in ("blocked", "labelled", "pb", "pl"))
    gap = F.greatest(F.abs(b * (pl - l) - (pb - b) * l) - pl / 2, F.lit(0.0))
    return (l < pl) & (pl * gap * gap <= CHI2 * l * (pl - l) * pb * (pl - pb))


def templates(base: DataFrame) -> DataFrame:
    """(host, s1.., more) of every path with its template t1.. and the template's purity."""
    keys = ["host", *(f"s{k}" for k in range(1, DEPTH + 1)), "more"]
    paths = base.withColumns(_segments()).groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("ruling") == "block", 1)).alias("blocked"),
        F.count("ruling").alias("labelled"),
    )
    paths = materialize(paths, "url-paths")
    above = ["host"]
    for k in range(1, DEPTH + 1):
        seg = paths.groupBy(*above, f"s{k}").agg(F.sum("n").alias("sn"))
        node = seg.groupBy(*above).agg(F.sum("sn").alias("pn"), F.count("*").alias("kinds"))
        # only the segments that become wildcards are told apart
        wild = seg.join(node, above).filter((F.col("kinds") > BRANCHES) & (F.col("sn") < RARE * F.col("pn"))).select(*above, f"s{k}", F.lit("*").alias(f"t{k}"))
        paths = paths.join(wild, [*above, f"s{k}"], "left").withColumn(f"t{k}", F.coalesce(f"t{k}", f"s{k}"))
        kin = _totals(paths.filter("labelled > 0"), [*above, f"t{k}"])
        node = kin.groupBy(*above).agg(F.sum("blocked").alias("pb"), F.sum("labelled").alias("pl"))
        alike = kin.join(node, above).filter(_like_siblings()).select(*above, f"t{k}", F.lit(MERGED).alias("mark"))
        paths = paths.join(alike, [*above, f"t{k}"], "left").withColumn(f"t{k}", F.coalesce("mark", f"t{k}")).drop("mark")
        paths = materialize(paths, "url-paths")
        above = [*above, f"t{k}"]
    leaf_keys = [*above, "more"]
    leaf = _totals(paths, leaf_keys)
    level = {len(above): _totals(leaf, above)}
    for k in range(len(above) - 1, 0, -1):
        level[k] = _totals(level[k + 1], above[:k])
    smooth = (F.col("blocked") + WEIGHT * F.col("up")) / (F.col("labelled") + WEIGHT)
    purity = level[1].withColumn("up", F.lit(NEUTRAL))
    purity = purity.withColumn("up", smooth)
    for k in range(2, len(above) + 1):
        child = level[k].join(purity.select(*above[: k - 1], "up"), above[: k - 1])
        purity = child.withColumn("up", smooth)
    parent = purity.select(*above, F.col("blocked").alias("pb"), F.col("labelled").alias("pl"), "up")
    b, l, pb, pl = (F.col(c).cast("double") for c in ("blocked", "labelled", "pb", "pl"))
    alike = (b * pl - pb * l) * (b * pl - pb * l) <= CHI2 * pb * (pl - pb) * l
    own = F.when(alike, (F.col("pb") + WEIGHT * F.col("up")) / (F.col("pl") + WEIGHT)).otherwise(smooth)
    judged = leaf.join(parent, above).select(*leaf_keys, own.alias("purity"))
    return paths.join(judged, leaf_keys).select(*keys, *above[1:], "purity")


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template and purity; see the contract of op8."""
    base = materialize(ruled(pages, rules), "url-pages")
    found = templates(base)
    keys = ["host", *(f"s{k}" for k in range(1, DEPTH + 1)), "more"]
    tree = F.concat(F.lit("/"), F.concat_ws("/", *(f"t{k}" for k in range(1, DEPTH + 1))), F.when(F.col("more"), "/**").otherwise(""))
    out = base.withColumns(_segments()).join(found, keys)
    method = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruling", method).alias("verdict"), tree.alias("template"), "purity")


def _sql() -> str:
    rule, ruling = "NULL", "NULL"
    for text, verdict in sorted(RULES, key=lambda r: (len(r[0]), r[0])):
        h, _, p = text.partition("/")
        fits = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}')"
        rule, ruling = f"CASE WHEN {fits} THEN '{text}' ELSE {rule} END", f"CASE WHEN {fits} THEN '{verdict}' ELSE {ruling} END"
    steps, above = [], "host"
    for k in range(1, DEPTH + 1):
        steps.append(f"""
w{k} AS (SELECT {above}, s{k}, sum(n) AS sn, sum(sum(n)) OVER (PARTITION BY {above}) AS pn, count(*) OVER (PARTITION BY {above}) AS kinds FROM p{k - 1} GROUP BY {above}, s{k}),
a{k} AS (SELECT p{k - 1}.*, CASE WHEN kinds > {BRANCHES} AND sn < {RARE} * pn THEN '*' ELSE s{k} END AS t{k} FROM p{k - 1} JOIN w{k} USING ({above}, s{k})),
q{k} AS (SELECT {above}, t{k}, sum(blocked)::DOUBLE AS b, sum(labelled)::DOUBLE AS l FROM a{k} GROUP BY {above}, t{k}),
r{k} AS (SELECT *, sum(b) OVER (PARTITION BY {above}) AS pb, sum(l) OVER (PARTITION BY {above}) AS pl FROM q{k}),
g{k} AS (SELECT *, greatest(abs(b * (pl - l) - (pb - b) * l) - pl / 2, 0.0) AS gap FROM r{k}),
m{k} AS (SELECT {above}, t{k}, l > 0 AND l < pl AND pl * gap * gap <= {CHI2}::DOUBLE * l * (pl - l) * pb * (pl - pb) AS alike FROM g{k}),
p{k} AS (SELECT a{k}.* REPLACE (CASE WHEN alike THEN '{MERGED}' ELSE a{k}.t{k} END AS t{k}) FROM a{k} JOIN m{k} USING ({above}, t{k}))""")
        above += f", t{k}"
    keys = above.split(", ")
    sums = "sum(blocked)::DOUBLE AS b, sum(labelled)::DOUBLE AS l"
    w, levels = WEIGHT, [f"u0 AS (SELECT host, sum(blocked)::DOUBLE b, sum(labelled)::DOUBLE l, (sum(blocked) + {WEIGHT} * {NEUTRAL}) / (sum(labelled) + {WEIGHT}) AS up FROM p{DEPTH} GROUP BY host)"]
    for k in range(1, DEPTH + 1):
        now, up = ", ".join(keys[: k + 1]), ", ".join(keys[:k])
        levels.append(f"u{k} AS (SELECT x.*, (x.b + {w} * y.up) / (x.l + {w}) AS up FROM (SELECT {now}, {sums} FROM p{DEPTH} GROUP BY {now}) x JOIN (SELECT {up}, up FROM u{k - 1}) y USING ({up}))")
    d = DEPTH
    segs = ", ".join(f"split_part(path, '/', {k + 1}) AS s{k}" for k in range(1, d + 1))
    skeys = "host, " + ", ".join(f"s{k}" for k in range(1, d + 1)) + ", more"
    tree = " || '/' || ".join(f"t{k}" for k in range(1, d + 1))
    return f"""
WITH raw AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
cut AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS authority FROM raw),
hp AS (SELECT page_id, translate(authority, '{_UPPER}', '{_UPPER.lower()}') AS host, regexp_extract(substr(rest, length(authority) + 1), '^[^?#]*') AS path FROM cut),
base AS (SELECT *, {rule} AS rule, {ruling} AS ruling, {segs}, split_part(path, '/', {d + 2}) <> '' AS more FROM hp),
p0 AS (SELECT {skeys}, count(*) AS n, count(CASE WHEN ruling = 'block' THEN 1 END) AS blocked, count(ruling) AS labelled FROM base GROUP BY {skeys}),{",".join(steps)},
{", ".join(levels)},
leaf AS (SELECT {above}, more, {sums} FROM p{d} GROUP BY {above}, more),
judged AS (SELECT {above}, more, CASE WHEN (x.b * y.l - y.b * x.l) * (x.b * y.l - y.b * x.l) <= {CHI2} * y.b * (y.l - y.b) * x.l
  THEN (y.b + {w} * up) / (y.l + {w}) ELSE (x.b + {w} * up) / (x.l + {w}) END AS purity FROM leaf x JOIN u{d} y USING ({above}))
SELECT page_id, host, path, rule, coalesce(ruling, CASE WHEN purity >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict,
  '/' || {tree} || CASE WHEN more THEN '/**' ELSE '' END AS template, purity
FROM base JOIN p{d} USING ({skeys}) JOIN judged USING ({above}, more)"""


ORACLE_SQL = _sql()
__all__ = ["RULES", "ORACLE_SQL", "host_and_path", "judge", "ruled", "templates"]
