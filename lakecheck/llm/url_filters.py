"""URL filters: hand-written rules first, then a path-template tree per host.

Each host's paths form a tree of segments.  Level by level, a segment that varies - it has digits, or its parent
has more than ``MAX_BRANCHES`` values of which this one holds less than ``MIN_SHARE`` - becomes a wildcard, so
paths become templates, down to the last segment: a level is made for the paths that still share their template so
far with another path, and a path that is alone in its branch gets the rest of its template at once.  Templates carry counts of labelled good and bad pages.  Sibling templates (same host and
parent) whose bad rate does not differ significantly from their pool (|z| < ``Z``) are merged into it.  A template is
rejected if its smoothed bad share, drawn to the host's rate and that to the corpus's, reaches ``REJECT``.

Only native functions; every level is one grouped count, combined before the shuffle, so a hot host
is as many partial rows as it has branches; sums over a branch or a host are grouped and joined back, never a window
over all of its rows.

Defined cases: a NULL url or one without ``://`` has an empty host and path, no rule and the verdict of the template of
empty path of the empty host; NULL labels count nowhere; pages with equal urls get the same verdict; without labels
everything without a blocking rule is allowed; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecheck.llm.common import stored

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
MAX_BRANCHES = 16
MIN_SHARE = 0.01
SMOOTH = 10            # pseudo-pages of the parent rate
Z = 2.0
REJECT = 0.5
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def split_url(url: Column) -> dict[str, Column]:
    """host and path columns."""
    u = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("coalesce(__url, '')"))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return {"host": F.translate(host, _UPPER, _UPPER.lower()), "path": path}


def rule_columns(rules=None) -> tuple[Column, Column]:
    """The longest fitting rule and its action, or NULL."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, h, p in sorted(rules if rules is not None else RULES, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, action = F.when(fits, h + p).otherwise(rule), F.when(fits, act).otherwise(action)
    return rule, action


def _segment(seg: Column) -> Column:
    return F.when(seg.rlike("[0-9]"), F.lit("*")).otherwise(seg)


def templates(pages: DataFrame) -> DataFrame:
    """(host, path, template) of every distinct path.  ``pages``: host, path."""
    b = pages.groupBy("host", "path").agg(F.count("*").alias("n"))
    segs = F.split(F.regexp_replace("path", r"^/", ""), "/", -1)
    open_ = stored(b.withColumn("__s", segs).withColumn("template", F.when(F.col("path") == "", "").otherwise("/")), "paths")
    done, k = [], 0
    while True:
        # branches: the values of the next segment under each template that paths still share
        at = open_.withColumn("__v", _segment(F.get(F.col("__s"), F.lit(k))))
        branch = at.groupBy("host", "template", "__v").agg(F.sum("n").alias("__n"), F.count("*").alias("__rows"))
        whole = branch.groupBy("host", "template").agg(F.sum("__n").alias("__all"), F.count("*").alias("__k"), F.sum("__rows").alias("__paths"))
        wild = (F.col("__k") > MAX_BRANCHES) & (F.col("__n") < F.col("__all") * MIN_SHARE)
        named = branch.join(whole, ["host", "template"]).select("host", "template", "__v", "__paths", F.when(wild, "*").otherwise(F.col("__v")).alias("__w"))
        at = at.join(named, ["host", "template", "__v"])
        rest = F.array_join(F.transform(F.slice("__s", k + 1, F.size("__s")), _segment), "/")
        step = F.concat("template", "__w", F.when(F.size("__s") > k + 1, "/").otherwise(""))
        alone = F.col("__paths") == 1
        at = stored(at.withColumn("template", F.when(alone, F.concat("template", rest)).otherwise(step)).withColumn(
            "__end", alone | (F.size("__s") <= k + 1)).drop("__v", "__w", "__paths"), f"level{k}")
        done.append(at.where("__end").select("host", "path", "template"))
        open_, k = at.where("not __end").drop("__end"), k + 1
        if not open_.limit(1).count():
            break
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out


def purity(labelled: DataFrame) -> DataFrame:
    """(host, template, bad_share): smoothed share of bad pages.  ``labelled``: host, template, bad (0, 1 or NULL)."""
    t = labelled.groupBy("host", "template").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("b"))
    t = stored(t.withColumn("parent", F.regexp_extract("template", r"^(.*/)[^/]*/?$", 1)), "template-counts")
    whole = t.agg(F.sum("n").alias("n"), F.sum("b").alias("b")).first()
    rate = (whole["b"] or 0) / whole["n"] if whole["n"] else 0.0
    pool = t.groupBy("host", "parent").agg(F.sum("n").alias("pn"), F.sum("b").alias("pb"))
    host = pool.groupBy("host").agg(F.sum("pn").alias("hn"), F.sum("pb").alias("hb"))
    t = t.join(pool, ["host", "parent"]).join(host, "host").withColumn("h", (F.col("hb") + F.lit(SMOOTH * rate)) / (F.col("hn") + SMOOTH))
    r = F.when(F.col("pn") > 0, F.col("pb") / F.col("pn")).otherwise(0.0)
    z = F.when((F.col("n") > 0) & (r > 0) & (r < 1), (F.col("b") / F.col("n") - r) / F.sqrt(r * (1 - r) / F.col("n"))).otherwise(0.0)
    merged = F.abs(z) < Z
    n, b = F.when(merged, F.col("pn")).otherwise(F.col("n")), F.when(merged, F.col("pb")).otherwise(F.col("b"))
    return t.select("host", "template", merged.alias("merged"), ((b + SMOOTH * F.col("h")) / (n + SMOOTH)).alias("bad_share"))


def judge(pages: DataFrame, labels: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", rules=None) -> DataFrame:
    """(id, host, path, rule, verdict, template, bad_share).  ``labels``: (id, bad 0/1), at most one row per id."""
    p = pages.select(F.col(id_col), F.col(url_col).cast("string").alias("__url"))
    p = p.withColumns(split_url(F.col("__url"))).drop("__url")
    rule, action = rule_columns(rules)
    t = stored(templates(p.select("host", "path")), "templates")
    lab = p.join(labels.select(id_col, "bad"), id_col, "left") if labels is not None else p.withColumn("bad", F.lit(None).cast("int"))
    tree = stored(purity(lab.join(t, ["host", "path"]).select("host", "template", F.col("bad").cast("long").alias("bad"))), "tree")
    out = p.join(t.join(tree, ["host", "template"]), ["host", "path"])
    own = F.when(F.col("bad_share") >= REJECT, "block").otherwise("allow")
    return out.select(id_col, "host", "path", rule.alias("rule"), F.coalesce(action, own).alias("verdict"), "template", "bad_share")
