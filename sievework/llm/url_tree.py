"""URL filters: rules by host and path, and a path-template tree for the rest.

Rules name a host and a path prefix; the longest rule that fits a url
decides.  A url that no rule fits is judged by its template.  Templates are
learned from all urls: per host, paths are walked from the root, and at
every node the next segments are generalised to a wildcard if they vary,
that is if there are many different ones for the number of urls below
(digits and long hexadecimal names count as one from the start).  Then
branches with like label shares are merged: the children of a node whose
shares of bad labels don't differ significantly pool their counts, so a
branch with few labels borrows from its kin.  What a template lacks in
labels it borrows from the nodes above it, the host, and the host's parent
domains, all of them: going down this chain from the share of
bad labels among all, a level's share is (bad + PRIOR_WEIGHT * share above)
/ (labelled + PRIOR_WEIGHT), where bad and labelled leave out the next level,
so that no label counts twice.  A template is rejected if its share so
smoothed reaches ``REJECT_AT``.

Labels are a column of the caller (1 bad, 0 good, null unknown); the query
of this package takes the verdicts of the rules themselves, so a host's
unruled branches are judged by how its ruled ones came out, and a host
without any by its domain.

Scale: the work is a walk down the tree, not over urls.  Urls are summed to
(host, path shape) once.  A round takes ``LEVELS`` depths at once, as what
varies at a node changes nothing above it: a shape goes down to its first
node that varies, or to the round's end.  Segments that all shapes of a node
have in common are passed in one step.  Shapes that are alone at their node,
or whose node has nothing below, leave the walk, so rounds are few and carry
what is still undecided.  Only paths that end at each of very many depths
(/a, /a/a, ...) take many: one round for ``LEVELS`` of these depths.
Sums are by (host, prefix), which spreads a host with a third of all urls
over its prefixes, and partial before they are shuffled.  Joins back to the
shapes are plain shuffled joins, which Spark splits where a key is hot.

Defined results: a null url, or one without ``://``, has empty host and
path and no rule, and is allowed by the method (there's nothing to judge);
rows are judged alike if their urls are equal; a null id is carried
through; an empty table gives an empty result.  Only the named columns are
read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.plans.shared import materialize

#: Different next segments from which, and share of them among the urls below from which, a node's segments vary.
MANY, VARIED = 8, 0.2
PRIOR_WEIGHT = 4.0
REJECT_AT = 0.8
#: Parent domains of a host that its templates borrow from, the last label first: as many as a legal name has.
DOMAINS = 126
#: Depths that one round of the walk takes.
LEVELS = 32
#: Two-proportion z-value below which sibling branches are alike.
ALIKE = 1.96


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    raw = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def match_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` (verdict, "host/path") that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def shape_of(path: Column) -> Column:
    """The path's segments; numbers and long hexadecimal names are wildcards."""
    general = F.regexp_replace(F.regexp_replace(path, r"[0-9a-fA-F]{16,}", "*"), r"[0-9]+", "*")
    return F.split(F.regexp_replace(general, "^/", ""), "/")


def _domains(shapes: DataFrame) -> DataFrame:
    """(host, above): label counts of a host's parent domains, the broadest first."""
    hosts = shapes.groupBy("host").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled"))
    parts = F.split("host", r"\.")
    size = F.size(parts)
    many = F.least(size - 1, F.lit(DOMAINS))
    names = F.transform(F.sequence(F.lit(1), many), lambda i: F.array_join(F.slice(parts, size - i + 1, i), "."))
    each = hosts.select("host", "bad", "labelled", F.posexplode(F.when(many > 0, names)).alias("level", "domain"))
    sums = each.groupBy("domain").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled"))
    found = each.select("host", "level", "domain").join(sums, "domain")
    return found.groupBy("host").agg(F.transform(F.sort_array(F.collect_list(F.struct("level", "bad", "labelled"))), lambda x: F.struct(x["bad"].alias("bad"), x["labelled"].alias("labelled"))).alias("above"))  # at most DOMAINS a host


def _borrow(share: Column, bad: Column, labelled: Column) -> Column:
    """The share of bad ones among so many, smoothed by the share above."""
    return (bad + PRIOR_WEIGHT * share) / (labelled + PRIOR_WEIGHT)


def _go_down(levels: Column, share: Column, bad: Column, labelled: Column) -> Column:
    """(share, bad, labelled) after ``levels``: the share of all above the last one, and the counts of that.

    A level counts without the one after it, so its share is taken when that
    is known; ``bad`` and ``labelled`` are null where no level came before.
    """
    start = F.struct(share.alias("share"), bad.alias("bad"), labelled.alias("labelled"))

    def step(x: Column, level: Column) -> Column:
        own = _borrow(x["share"], x["bad"] - level["bad"], x["labelled"] - level["labelled"])
        return F.struct(F.coalesce(own, x["share"]).alias("share"), level["bad"].alias("bad"), level["labelled"].alias("labelled"))

    return F.aggregate(levels, start, step)


_STATE = ("host", "shape", "n", "labelled", "bad", "template", "at", "above")


def _descend(state: DataFrame) -> DataFrame:
    """Every shape of ``state`` moved down by up to ``LEVELS`` depths, but not past a node that varies."""
    rest = F.size("shape") - F.col("at")
    each = state.select(*_STATE, F.explode(F.sequence(F.lit(0), F.least(rest, F.lit(LEVELS - 1)))).alias("level"))
    each = each.withColumn("prefix", F.slice("shape", F.col("at") + 1, F.col("level"))).withColumn("segment", F.get("shape", F.col("at") + F.col("level")))
    children = each.groupBy("host", "template", "prefix", "segment").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled"))
    nodes = children.groupBy("host", "template", "prefix").agg(
        F.count("segment").alias("different"), F.sum(F.when(F.col("segment").isNotNull(), F.col("n"))).alias("urls"), F.sum("bad").alias("node_bad"), F.sum("labelled").alias("node_labelled")
    )
    vary = (F.col("different") >= MANY) & (F.col("different") >= VARIED * F.col("urls"))
    met = each.join(nodes.select("host", "template", "prefix", vary.alias("vary"), "node_bad", "node_labelled"), ["host", "template", "prefix"])
    node = F.struct("level", "vary", F.col("node_bad").alias("bad"), F.col("node_labelled").alias("labelled"))
    passed = met.groupBy(*_STATE).agg(F.sort_array(F.collect_list(node)).alias("nodes"))  # at most LEVELS a shape
    first = F.array_position(F.transform("nodes", lambda x: x["vary"]), True)
    passed = passed.withColumn("first", F.when((first > 0) & (first <= rest), first.cast("int"))).withColumn("down", F.coalesce("first", F.least(rest, F.lit(LEVELS))))
    steps = F.slice("shape", F.col("at") + 1, F.col("down"))
    wild = F.col("first").isNotNull() & (F.get("shape", F.col("at") + F.col("down") - 1) != "")
    steps = F.when(wild, F.array_append(F.slice("shape", F.col("at") + 1, F.col("down") - 1), F.lit("*"))).otherwise(steps)
    template = F.when(F.col("down") > 0, F.concat("template", F.lit("/"), F.array_join(steps, "/"))).otherwise(F.col("template"))
    above = _go_down(F.slice("nodes", F.lit(1), F.col("down")), F.col("above.share"), F.col("above.bad"), F.col("above.labelled"))
    return passed.select("host", "shape", "n", "labelled", "bad", template.alias("template"), (F.col("at") + F.col("down")).alias("at"), above.alias("above"))


def learn_templates(urls: DataFrame) -> DataFrame:
    """(host, shape, template, bad, labelled, score, rejected) for rows (host, shape, label).

    ``shape`` is an array of segments; bad and labelled are those of the
    template with the branches it was merged with.  On the way down, ``above``
    holds the share of bad labels so far and the counts of the last level
    passed: the host's domains, the host, and the nodes.  A shape leaves the
    walk when it is alone at its node, where nothing varies and nothing is
    borrowed, or when all shapes of its node have ended.
    """
    shapes = materialize(
        urls.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).cast("long").alias("bad")), "url-shapes"
    )
    total = shapes.agg(F.coalesce(F.sum("bad") / F.sum("labelled").cast("double"), F.lit(0.0)).alias("prior"))  # one row
    domains = F.coalesce("domains", F.array().cast("array<struct<bad:bigint,labelled:bigint>>"))
    none = F.lit(None).cast("long")
    state = shapes.join(_domains(shapes).withColumnRenamed("above", "domains"), "host", "left").join(F.broadcast(total))
    state = state.select("host", "shape", "n", "labelled", "bad", F.lit("").alias("template"), F.lit(0).alias("at"), _go_down(domains, F.col("prior"), none, none).alias("above"))
    settled: list[DataFrame] = []
    while True:
        state = materialize(state, f"url-walk{len(settled)}")
        below = F.slice("shape", F.col("at") + 1, F.size("shape"))
        spots = state.groupBy("host", "template").agg(F.count("*").alias("shapes"), F.min(below).alias("least"), F.max(below).alias("most"), F.struct(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")).alias("node"))
        differ = F.array_position(F.zip_with("least", "most", lambda x, y: ~x.eqNullSafe(y)), True)  # what the first and last of a sorted set share, all share
        spots = spots.select("host", "template", ((F.col("shapes") > 1) & (F.size("most") > 0)).alias("open"), F.when(differ > 0, differ - 1).otherwise(F.size("most")).cast("int").alias("shared"), "node")
        told = materialize(state.join(spots, ["host", "template"]).select(*_STATE, "open", "shared", "node"), f"url-told{len(settled)}")
        settled.append(told.where(~F.col("open")).select(*_STATE))
        on = F.col("shared") > 0
        steps = F.array_join(F.slice("shape", F.col("at") + 1, F.col("shared")), "/")
        above = _go_down(F.array("node"), F.col("above.share"), F.col("above.bad"), F.col("above.labelled"))
        passed = {"template": F.when(on, F.concat("template", F.lit("/"), steps)).otherwise(F.col("template")), "at": F.col("at") + F.col("shared"), "above": F.when(on, above).otherwise(F.col("above"))}
        going = told.where("open").withColumns(passed).select(*_STATE)
        if going.isEmpty():
            break
        state = _descend(going)
    walked = reduce(DataFrame.unionByName, settled)
    rest = F.when(F.size("shape") > F.col("at"), F.concat("template", F.lit("/"), F.array_join(F.slice("shape", F.col("at") + 1, F.size("shape")), "/")))
    walked = materialize(walked.withColumn("template", F.coalesce(rest, "template")), "url-walked")
    leaves = materialize(walked.groupBy("host", "template").agg(F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"), F.first("above").alias("above")), "url-templates")
    scored = _merge_and_score(leaves)
    return walked.select("host", "shape", "template").join(scored.drop("n"), ["host", "template"])


def _merge_and_score(leaves: DataFrame) -> DataFrame:
    """Pool templates with their like siblings and score them.

    Siblings share host and parent.  Those with labels are summed by their
    share of bad ones, so a parent has a row a share, however many children;
    in the order of shares a new pool begins where two neighbours differ
    significantly.  A pool, or a template without labels, then borrows from
    the levels above; all rows of a template have the same ones.
    """
    known = leaves.withColumn("parent", F.regexp_replace("template", "/[^/]*$", "")).withColumn("share", F.when(F.col("labelled") > 0, F.col("bad") / F.col("labelled")))
    shares = known.where("labelled > 0").groupBy("host", "parent", "share").agg(F.sum("bad").alias("s_bad"), F.sum("labelled").alias("s_labelled"))
    order = Window.partitionBy("host", "parent").orderBy("share")
    n1, n2 = F.lag("s_labelled").over(order), F.col("s_labelled")
    p1, p2 = F.lag("share").over(order), F.col("share")
    both = (F.lag("s_bad").over(order) + F.col("s_bad")) / (n1 + n2)
    z = F.abs(p1 - p2) / F.sqrt(F.greatest(both * (1 - both), F.lit(1e-9)) * (1 / n1 + 1 / n2))
    pools = shares.withColumn("pool", F.sum(F.when(z >= ALIKE, 1).otherwise(0)).over(order))
    within = Window.partitionBy("host", "parent", "pool")
    pools = pools.withColumn("p_bad", F.sum("s_bad").over(within)).withColumn("p_labelled", F.sum("s_labelled").over(within)).select("host", "parent", "share", "p_bad", "p_labelled")
    every = known.join(pools, ["host", "parent", "share"], "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("p_bad", "p_labelled")})
    pool = F.struct(F.col("p_bad").alias("bad"), F.col("p_labelled").alias("labelled"))
    last = _go_down(F.array(pool), F.col("above.share"), F.col("above.bad"), F.col("above.labelled"))
    scored = every.withColumn("score", _borrow(last["share"], last["bad"], last["labelled"]))
    return scored.select("host", "template", "n", F.col("p_bad").alias("bad"), F.col("p_labelled").alias("labelled"), "score", (F.col("score") >= REJECT_AT).alias("rejected"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", labels: Column | None = None) -> DataFrame:
    """Per url: id, host, path, rule, verdict, template and score.

    ``labels`` is a column of ``pages`` with 1 for bad, 0 for good, null for
    unknown; by default the verdicts of the rules are the labels.
    """
    cut = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"), *([labels.alias("given")] if labels is not None else []))
    rule, by_rule = match_rule(F.col("host"), F.col("path"), rules)
    ruled = cut.withColumn("rule", rule).withColumn("by_rule", by_rule).withColumn("shape", shape_of(F.col("path")))
    label = F.col("given") if labels is not None else F.when(F.col("by_rule") == "block", 1).when(F.col("by_rule") == "allow", 0)
    ruled = materialize(ruled.withColumn("label", label.cast("int")), "url-rows")
    learned = learn_templates(ruled.select("host", "shape", "label"))
    joined = ruled.join(learned.select("host", "shape", "template", "score", "rejected"), ["host", "shape"], "left")
    verdict = F.coalesce("by_rule", F.when((F.col("host") != "") & F.col("rejected"), F.lit("block")).otherwise(F.lit("allow")))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "score")


#: The rules of the query.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
