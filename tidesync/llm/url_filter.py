"""URL filter: curated host/path rules, then association rules mined from labelled URLs.

Curated rules are matched by an equi-join on host suffixes. URLs that no curated rule fits are
judged by rules ``{token, ...} -> label`` that FP-growth mined from labelled URLs; each mined rule is
indexed under its rarest token, so a URL meets only rules that share this token. Tokens that training saw
under both labels are mined together, those that always stand together as one. A token that met one label
alone makes a rule by itself (any longer one is no surer), unless the hosts it stood under did so too.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no curated rule
and is allowed by default. Repeated URLs get equal verdicts. With no labelled URL, or none that yields
a rule, every unruled URL gets the default. Further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import ascii_lower, literal_rows, saved, small_broadcast, table

ALLOW, BLOCK = "allow", "block"
HOST_TOKEN = "^h[0-9]+:"                           # tokens of a host's parts
LABEL = "label="                                   # marks the label item of a training transaction
TASKS_PER_CORE = 4                                 # of steps that only read rows through or handle rules
MAX_BROADCAST_RULES = 100_000                      # rules sent to every executor at most; more are shuffled


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): the host after the first ``://`` up to ``/ ? #``, the path then up to ``? #``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: host labels by level from the right, path segments (numbers as one token),
    file ending and query keys."""
    labels = F.reverse(F.split(host, r"\."))
    of_host = F.transform(labels, lambda x, i: F.concat(F.lit("h"), i.cast("string"), F.lit(":"), x))
    segments = F.filter(F.split(F.regexp_replace(path, r"\.[A-Za-z0-9]{1,8}$", ""), "/"), lambda x: x != "")
    of_path = F.transform(segments, lambda x: F.concat(
        F.lit("p:"), F.when(x.rlike(r"^[0-9]+$"), F.lit("<number>")).otherwise(x)))
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1)
    of_ending = F.when(ending != "", F.array(F.concat(F.lit("e:"), ending))).otherwise(F.array().cast("array<string>"))
    keys = F.regexp_extract_all(F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1), F.lit("([^&=]+)=?[^&]*"), 1)
    of_query = F.transform(keys, lambda x: F.concat(F.lit("q:"), x))
    return F.array_distinct(F.concat(of_host, of_path, of_ending, of_query))


def match_rules(urls: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``urls`` (url, host, path; distinct urls) with ``rule`` and ``rule_verdict`` of the longest
    fitting rule (host and path together; then the longer host; then block), else null."""
    curated = literal_rows(urls.sparkSession, ["rule_host", "rule_path", "rule_verdict"], rules)
    labels = F.split("host", r"\.")
    most = max((h.count(".") + 1 for h, _, _ in rules), default=1)      # longer suffixes meet no rule
    suffixes = F.transform(F.sequence(F.greatest(F.size(labels) - most + 1, F.lit(1)), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    fits = (urls.withColumn("suffix", F.explode(suffixes))
            .join(curated, (F.col("suffix") == F.col("rule_host")) & F.col("path").startswith(F.col("rule_path"))))
    rank = F.struct((F.length("rule_host") + F.length("rule_path")).alias("length"),
                    F.length("rule_host").alias("host_length"), (F.col("rule_verdict") == BLOCK).alias("blocks"),
                    F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict")
    best = fits.groupBy("url").agg(F.max(rank).alias("best"))
    return urls.join(best, "url", "left").select(*urls.columns, "best.rule", "best.rule_verdict")


def _narrow(df: DataFrame) -> DataFrame:
    """``df`` in a few tasks a core at most: for rows that are only read through, and for tables of rules and frequent
    tokens, which do not grow with the input. A task a shuffle partition would cost more than its work, in every step."""
    return df.coalesce(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)


def token_counts(labelled: DataFrame) -> DataFrame:
    """(token, n, allowed, rows, mixed) from rows (tokens, label): how many rows hold a token, how many of them allow, and
    two digests of the rows."""
    row = F.xxhash64("tokens")
    return saved(labelled.select("label", row.alias("row"), F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == ALLOW).alias("allowed"),
        F.sum(F.col("row").cast("decimal(20,0)")).alias("rows"), F.bit_xor("row").alias("mixed")))


def contested_classes(labelled: DataFrame, min_support: float, counts: DataFrame | None = None, total: int | None = None) -> DataFrame:
    """(class, members) of the tokens that are mined together, from rows (tokens, label): frequent ones that were seen
    under both labels (``one_label_rules`` has the rules of the others). Tokens that stand in exactly the same rows are
    one class, named by its smallest: alone and together they have equal rules, and their subsets need not be mined.
    ``counts`` and ``total`` are the rows' ``token_counts`` and number, where they are known."""
    least = min_support * (labelled.count() if total is None else total)
    counts = _narrow(token_counts(labelled) if counts is None else counts)
    # at most (tokens of a row) / min_support tokens are left
    some = counts.filter((F.col("n") >= least) & (F.col("allowed") > 0) & (F.col("allowed") < F.col("n")))
    return saved(_narrow(some.groupBy("n", "allowed", "rows", "mixed").agg(F.array_sort(F.collect_list("token")).alias("members"))
                         .select(F.col("members")[0].alias("class"), "members")))


def _names(table: DataFrame, column: str) -> Column:
    """The values of a column of a table that does not grow with the input, as one array."""
    return table.agg(F.collect_set(column).alias("names")).scalar()


def one_label_rules(labelled: DataFrame, min_support: float, counts: DataFrame | None = None, total: int | None = None) -> DataFrame:
    """(antecedent, label, confidence, support, index_token, any_of): the rules of the frequent tokens that met one label
    alone, from rows (tokens, label). Each holds for sure, and no longer antecedent with its token is surer, so these are
    all the rules such tokens have. A rule needs lift over its hosts' base rate: where every part of every host that a
    token stood under met that label alone as well, the hosts say it and not the token. ``counts`` and ``total`` are as
    in ``contested_classes``."""
    total = labelled.count() if total is None else total
    counts = _narrow(token_counts(labelled) if counts is None else counts)
    # at most (tokens of a row) / min_support tokens
    sure = saved(counts.filter((F.col("n") >= min_support * total) & ((F.col("allowed") == 0) | (F.col("allowed") == F.col("n")))).select("token", "n"))
    # each part of a host with its labels and the sure tokens that stood beside it
    beside = (labelled.select("tokens", "label", _names(sure, "token").alias("names"))
              .select("label", F.array_intersect("tokens", "names").alias("found"),
                      F.explode(F.filter("tokens", lambda t: t.rlike(HOST_TOKEN))).alias("host")))
    allows = F.col("label") == ALLOW
    hosts = (beside.select("host", "label", F.explode_outer("found").alias("token")).groupBy("host")
             .agg(F.count_if(allows).alias("allowed"), F.count_if(F.coalesce(~allows, F.lit(True))).alias("others"),
                  F.collect_set(F.when(F.col("token").isNotNull(), F.struct("token", "label"))).alias("pairs")))
    lifted = (hosts.filter((F.col("allowed") > 0) & (F.col("others") > 0)).select(F.explode("pairs").alias("pair")).distinct()
              .select("pair.*").join(F.broadcast(sure), "token"))
    return saved(_narrow(lifted.select(
        F.array("token").alias("antecedent"), "label", F.lit(1.0).alias("confidence"),
        (F.col("n") / F.lit(float(max(total, 1)))).alias("support"), F.col("token").alias("index_token"),
        F.array(F.array("token")).alias("any_of"))))


def in_classes(labelled: DataFrame, classes: DataFrame) -> DataFrame:
    """(tokens, label) rows with classes for tokens, the others left out; rows without any stay. A row that holds a class's
    first member, its name, holds all of them."""
    return (labelled.select("tokens", "label", _names(classes, "class").alias("names"))
            .select(F.array_sort(F.array_intersect("tokens", "names")).alias("tokens"), "label"))


def with_members(rules: DataFrame, classes: DataFrame) -> DataFrame:
    """Mined rules over classes as rules over tokens: ``any_of`` holds the members of each class of the antecedent,
    of which a URL needs one; the rarest class is indexed under all its members."""
    classes = small_broadcast(classes, MAX_BROADCAST_RULES)
    of = classes.select(F.col("class").alias("index_class"), F.col("members").alias("indexed"))
    each = rules.withColumn("class", F.explode("antecedent")).join(classes, "class") \
        .groupBy("antecedent", "label", "confidence", "support", F.col("index_token").alias("index_class")) \
        .agg(F.collect_list("members").alias("any_of"))
    return saved(_narrow(each.join(of, "index_class").withColumn("index_token", F.explode("indexed")).drop("index_class", "indexed")))


def mine_rules(labelled: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """(antecedent, label, confidence, support, index_token) from rows (tokens, label).

    A rule is kept if it reaches both bounds and no shorter antecedent inside it gives the same label
    at least as surely. ``min_support`` is a share of the labelled rows, so the number of frequent
    tokens per row, and with it the rule table, does not grow with the input.
    """
    spark = labelled.sparkSession
    if labelled.isEmpty():
        return spark.createDataFrame([], "antecedent array<string>, label string, confidence double, support double, "
                                         "index_token string")
    # it mines in as many partitions as these, and a row goes to each that one of its items is dealt to
    items = _narrow(labelled.select(F.array_append("tokens", F.concat(F.lit(LABEL), "label")).alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = saved(model.associationRules.filter(F.col("consequent")[0].startswith(LABEL))
                  .select(F.array_sort("antecedent").alias("antecedent"),
                          F.substring(F.col("consequent")[0], len(LABEL) + 1, 1000).alias("label"),
                          "confidence", "support"))
    single = small_broadcast(saved(model.freqItemsets.filter(F.size("items") == 1)
                                   .select(F.col("items")[0].alias("token"), "freq")), MAX_BROADCAST_RULES)
    shorter = small_broadcast(rules, MAX_BROADCAST_RULES).select(
        F.col("antecedent").alias("sub"), F.col("label").alias("sub_label"),
        F.col("confidence").alias("sub_confidence"), F.col("antecedent")[0].alias("sub_token"))
    # a shorter rule inside another has its first token there: an equi-join on tokens, not all pairs
    inside = ((F.col("token") == F.col("sub_token")) & (F.col("label") == F.col("sub_label"))
              & (F.size("sub") < F.size("antecedent")) & (F.col("sub_confidence") >= F.col("confidence"))
              & (F.size(F.array_except("sub", "antecedent")) == 0))
    rarest = (rules.withColumn("token", F.explode("antecedent")).join(single, "token").join(shorter, inside, "left")
              .groupBy("antecedent", "label", "confidence", "support")
              .agg(F.min(F.struct("freq", "token")).alias("rarest"), F.count("sub").alias("inside")).filter("inside = 0"))
    return saved(_narrow(rarest.select("antecedent", "label", "confidence", "support", F.col("rarest.token").alias("index_token"))))


def apply_mined(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, mined): the label of the surest rule whose tokens all stand in the url's tokens (then the
    best supported, then allow before block). URLs without a match are left out."""
    fits = F.forall("any_of", lambda members: F.arrays_overlap(members, F.col("tokens"))) if "any_of" in rules.columns \
        else F.size(F.array_except("antecedent", "tokens")) == 0
    hits = urls.select("url", "tokens", F.explode("tokens").alias("index_token")).join(small_broadcast(rules, MAX_BROADCAST_RULES), "index_token").filter(fits)
    rank = F.struct("confidence", "support", (F.col("label") == ALLOW).alias("allows"), "label")
    return hits.groupBy("url").agg(F.max(rank).alias("best")).select("url", F.col("best.label").alias("mined"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], labelled: DataFrame | None = None,
                min_support: float = 0.01, min_confidence: float = 0.8) -> DataFrame:
    """(page_id, url, host, path, rule, verdict) for every page.

    ``labelled`` (url, label) trains the association rules; by default every distinct URL that a
    curated rule judges counts as labelled with that rule's verdict.
    """
    host, path = url_parts(F.col("url"))
    urls = pages.select("url").filter(F.col("url").isNotNull()).distinct().select("url", host.alias("host"), path.alias("path"))
    judged = saved(match_rules(urls, rules).withColumn(
        "tokens", url_tokens(F.col("url"), F.col("host"), F.col("path"))))
    if labelled is None:
        training = judged.filter(F.col("rule").isNotNull()).select("tokens", F.col("rule_verdict").alias("label"))
    else:
        h, p = url_parts(F.col("url"))
        training = saved(labelled.filter(F.col("url").isNotNull()).select(url_tokens(F.col("url"), h, p).alias("tokens"), "label"))
    training = _narrow(training)
    counts, total = token_counts(training), training.count()
    classes = contested_classes(training, min_support, counts, total)
    rules_found = with_members(mine_rules(in_classes(training, classes), min_support, min_confidence), classes)
    rules_found = rules_found.unionByName(one_label_rules(training, min_support, counts, total))
    judged = _narrow(judged)
    mined = apply_mined(judged.filter(F.col("rule").isNull()), rules_found)
    verdicts = judged.join(mined, "url", "left").select(
        "url", "rule", F.coalesce("rule_verdict", "mined", F.lit(ALLOW)).alias("verdict"))
    return (pages.select("page_id", "url").join(verdicts, "url", "left")
            .select("page_id", "url", host.alias("host"), path.alias("path"), "rule",
                    F.coalesce("verdict", F.lit(ALLOW)).alias("verdict")))


# The contract's rules (host, path, verdict).
CONTRACT_RULES = [
    ("com", "/", ALLOW),
    ("example.com", "/en/", BLOCK),
    ("www.example.com", "/en/", ALLOW),
    ("net", "/es/", BLOCK),
    ("net", "/fr/", BLOCK),
]


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), CONTRACT_RULES).drop("url")
