"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesift import fixed
from pagesift.functions import hashing, text, urls
from pagesift.operators import assemble, classify, decide, exact, filters, near, rule_tables, words
from pagesift.operators import simhash as similarity
from pagesift.operators.lookup import fits
from pagesift.plans.articles import publish
from pagesift.plans.backfill import run_range
from pagesift.plans.duplicates import run_duplicates
from pagesift.plans.labels import label_articles
from pagesift.session import new_path, stage
from pagesift.sources import rules as rule_files
from pagesift.sources import tables
from pagesift.testbed import data
from pagesift.testbed.data import DAY, FIRST_DAY, LAST_DAY_EXCLUSIVE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


def _prob(name: str = "prob"):
    return F.round(name, 6).alias(name)


# Scans, sources, sinks


@query
def crawl_day(spark, sf_dir):
    """Store the crawl by day, then read the range of all its days."""
    path = new_path(spark, "crawl")
    tables.write_days(data.crawl(spark, sf_dir), path)
    rows = tables.read_crawl(spark, path, FIRST_DAY, LAST_DAY_EXCLUSIVE)
    return rows.select("fid", DAY, "src_type", F.length("fcontent").alias("fcontent_len"))


@query
def source_whitelist(spark, sf_dir):
    return tables.keep_sources(data.crawl(spark, sf_dir), data.SOURCES).select("fid", "src_type")


@query
def drop_partition_col(spark, sf_dir):
    rows = data.crawl(spark, sf_dir).select("fid", "furl", "ftitle", "fkeywords", "src_type", DAY)
    return tables.drop_day(rows)


@query
def sink_roundtrip(spark, sf_dir):
    """Write all days, write the second half of the month again, read rows per day."""
    path = new_path(spark, "sink")
    rows = data.crawl(spark, sf_dir).select("fid", "src_type", DAY)
    tables.write_days(rows.withColumn("version", F.lit(1)), path, rebalance=True)
    later = rows.where(F.col(DAY) >= "20240116").withColumn("version", F.lit(2))
    tables.write_days(later, path, rebalance=True)
    back = tables.read_days(spark, path, FIRST_DAY, LAST_DAY_EXCLUSIVE)
    return back.groupBy(DAY, "version").agg(F.count("*").alias("n"), F.sum("fid").alias("sum_fid"))


@query
def rule_lines(spark, sf_dir):
    """A rule file made of the page URLs, every URL followed by a blank line."""
    path = new_path(spark, "rules")
    lines = data.pages(spark, sf_dir).select(
        F.explode(F.array(F.concat(F.lit(" "), F.col("url")), F.lit(" \t"), F.lit(""))).alias("value")
    )
    lines.write.text(path)
    return rule_files.load_rules(spark, path).groupBy("pattern").agg(F.count("*").alias("n"))


@query
def label_rules(spark, sf_dir):
    """Rule lines ``site<tab>language`` from the crawl, some with a third part."""
    rows = data.crawl(spark, sf_dir).select("fid", "fkeywords", urls.site(F.col("furl")).alias("furl"))
    third = F.when(F.col("fkeywords") == "de", F.lit(" extra")).otherwise(F.lit(" "))
    lines = rows.select(
        F.col("fid").alias("line_no"), F.concat("furl", F.lit(" \t"), "fkeywords", third).alias("value")
    )
    return rule_files.parse_label_rules(lines)


@query
def debug_limit(spark, sf_dir):
    rows = data.crawl(spark, sf_dir).select("fid", "furl", "src_type")
    return tables.debug_limit(rows, 250)


# Projections, filters, scalars


@query
def site_strict(spark, sf_dir):
    return data.pages(spark, sf_dir).select("page_id", urls.site_strict(F.col("url")).alias("furl"))


@query
def site(spark, sf_dir):
    return data.pages(spark, sf_dir).select("page_id", urls.site(F.col("url")).alias("furl"))


@query
def content_len(spark, sf_dir):
    return data.documents(spark, sf_dir).select(
        F.col("doc_id").alias("fid"), text.content_len(F.col("text")).alias("fcontent_len")
    )


@query
def url_blacklist(spark, sf_dir):
    rows = data.pages(spark, sf_dir).select("page_id", urls.site(F.col("url")).alias("furl"))
    return filters.not_blacklisted(rows, data.USELESS, data.COMMERCE)


@query
def url_table(spark, sf_dir):
    """Pages whose URL has no host of a table of blocked ones."""
    rows = data.pages(spark, sf_dir).select("page_id", F.col("url").alias("furl"))
    return rule_tables.not_listed(rows, data.host_patterns(spark, sf_dir, data.BLOCKED_LANG)).select("page_id")


@query
def error_body(spark, sf_dir):
    rows = data.documents(spark, sf_dir).select(F.col("doc_id").alias("fid"), F.col("text").alias("fcontent"))
    return rows.where(~filters.error_body(data.RULES)).select("fid")


@query
def junk_title(spark, sf_dir):
    """Both readings of the rule for every page title."""
    title = F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("ftitle")
    return data.pages(spark, sf_dir).select("page_id", title).select(
        "page_id",
        filters.title_ok(data.RULES).alias("intended"),
        filters.title_ok(data.RULES, as_built=True).alias("as_built"),
    )


def _articles(spark, sf_dir):
    rows = data.crawl(spark, sf_dir)
    return rows.withColumn("furl", urls.site(F.col("furl")))


@query
def drop_unusable(spark, sf_dir):
    return filters.drop_unusable(_articles(spark, sf_dir), data.RULES).select("fid", "furl", "ftitle")


# Text


@query
def keep_script(spark, sf_dir):
    kept = text.keep_script(F.col("text"), data.NOT_LETTERS)
    return data.documents(spark, sf_dir).select(F.col("doc_id").alias("fid"), kept.alias("kept"))


@query
def clean_markup(spark, sf_dir):
    return data.pages(spark, sf_dir).select("page_id", text.clean_markup(F.col("html")).alias("cleaned"))


@query
def tokenize(spark, sf_dir):
    """Title and content tokens in one pass."""
    tokens = words.title_content_tokens(data.crawl(spark, sf_dir))
    return tokens.select(
        "fid",
        text.join_tokens(F.col("title_tokens")).alias("title_words"),
        text.join_tokens(F.col("content_tokens")).alias("content_words"),
    )


@query
def keywords(spark, sf_dir):
    tokens = data.content_words(spark, sf_dir)
    kept = words.keywords(tokens, data.lexicon(spark, sf_dir))
    return words.words_table(kept, ",")


@query
def words_csv(spark, sf_dir):
    return words.words_table(data.hash_words(spark, sf_dir), ",")


# Similarity hash and groups


@query
def fnv1a64(spark, sf_dir):
    """Hash of every distinct word of the documents."""
    token = words.token_rows(data.content_words(spark, sf_dir), []).distinct()
    return token.where(F.col("token").isNotNull()).select("token", hashing.fnv1a64(F.col("token")).alias("hash"))


@query
def simhash(spark, sf_dir):
    return data.hashes(spark, sf_dir)


@query
def simhash_fnv(spark, sf_dir):
    return similarity.simhash64(data.hash_words(spark, sf_dir), token_hash=hashing.fnv1a64)


@query
def simhash_keywords(spark, sf_dir):
    """Hash of lexicon keywords without collecting them; 0 for texts with none."""
    return similarity.simhash_keywords(data.content_words(spark, sf_dir), data.lexicon(spark, sf_dir), token_hash=hashing.md5_64)


def _exact(spark, sf_dir):
    return exact.exact_groups(data.hashes(spark, sf_dir))


@query
def exact_groups(spark, sf_dir):
    return _exact(spark, sf_dir)


@query
def exact_members(spark, sf_dir):
    hashes = stage(data.hashes(spark, sf_dir), "hashes")
    return exact.exact_members(hashes, exact.exact_groups(hashes))


@query
def members_csv(spark, sf_dir):
    hashes = stage(data.hashes(spark, sf_dir), "hashes")
    return exact.members_csv(exact.exact_members(hashes, exact.exact_groups(hashes)), per_string=4)


@query
def mask_block(spark, sf_dir):
    h = F.col("hash")
    masked = [hashing.mask_block(h, b).alias(f"block{b}") for b in near.BLOCKS]
    return data.hashes(spark, sf_dir).select("fid", *masked)


@query
def near_pairs(spark, sf_dir):
    return near.near_pairs(_exact(spark, sf_dir))


@query
def near_pairs_k3(spark, sf_dir):
    """Pairs of hashes up to three bits apart."""
    return near.near_pairs(_exact(spark, sf_dir), k=3)


@query
def group_top(spark, sf_dir):
    return near.group_top(_exact(spark, sf_dir), 3)


def _shown(groups):
    return groups.select("fid", "hash", F.concat_ws(",", F.col("absorbed").cast("array<string>")).alias("samefid"), "samelen")


@query
def absorb_block(spark, sf_dir):
    """One pass of each block over the exact groups, as one table."""
    groups = stage(_exact(spark, sf_dir), "exact")
    passes = [_shown(near.absorb_block(groups, b)).withColumn("block", F.lit(b)) for b in near.BLOCKS]
    return classify.union_labels(*passes)


@query
def near_groups(spark, sf_dir):
    return _shown(near.near_groups(_exact(spark, sf_dir)))


@query
def near_groups_check(spark, sf_dir):
    """Sizes, members and distances of the final groups in one row."""
    hashes = stage(data.hashes(spark, sf_dir), "hashes")
    groups = stage(exact.exact_groups(hashes), "exact")
    passes = near.near_passes(groups)
    final, members = passes[-1], near.near_members(hashes, groups, passes)
    zero = F.lit(0).cast("bigint")
    counts = classify.union_labels(
        final.select(F.col("samelen"), zero.alias("members"), zero.alias("near_leaders")),
        members.groupBy("fid").agg(F.lit(1).cast("bigint").alias("members")).select(
            zero.alias("samelen"), "members", zero.alias("near_leaders")
        ),
        near.near_pairs(final).select(
            zero.alias("samelen"), zero.alias("members"), F.lit(1).cast("bigint").alias("near_leaders")
        ),
    )
    return counts.agg(*[F.sum(c).alias(c) for c in ("samelen", "members", "near_leaders")])


@query
def near_members(spark, sf_dir):
    hashes = stage(data.hashes(spark, sf_dir), "hashes")
    groups = stage(exact.exact_groups(hashes), "exact")
    return near.near_members(hashes, groups, near.near_passes(groups))


@query
def dup_report(spark, sf_dir):
    groups = near.near_groups(_exact(spark, sf_dir))
    leaders = stage(groups.where(F.col("samelen") >= 2), "leaders")
    return assemble.dup_report(leaders, data.crawl(spark, sf_dir), data.RULES, threshold=2, small=fits(leaders))


# Classification


def _words_and_models(spark, sf_dir):
    tokens = data.article_words(spark, sf_dir)
    return tokens, data.models(tokens, data.table(spark, sf_dir, "labels"))


@query
def score_parent(spark, sf_dir):
    tokens, models = _words_and_models(spark, sf_dir)
    return classify.score_labels(tokens, models, tokens="content_tokens").select("fid", "label", _prob())


@query
def score_label_only(spark, sf_dir):
    tokens, models = _words_and_models(spark, sf_dir)
    return classify.score_label_only(tokens, models, tokens="content_tokens")


@query
def score_codes(spark, sf_dir):
    """Whole titles by the next language's child model, or one that is not there,
    so that some texts are unknown; keywords of the titles, so that some are blank."""
    tokens, models = _words_and_models(spark, sf_dir)
    tokens = stage(tokens.select("fid", "lang", F.col("title_tokens").alias("tokens")), "titles")
    kept = words.keywords(tokens.select("fid", "tokens"), data.lexicon(spark, sf_dir), nature="v")
    model = F.when(F.col("lang") == "en", "de").when(F.col("lang") == "de", "fr").when(F.col("lang") == "fr", "none").otherwise("all")
    titles = tokens.select("fid", model.alias("model"), F.concat_ws(" ", "tokens").alias("words"))
    blanks = kept.select((-1 - F.col("fid")).alias("fid"), F.lit("all").alias("model"), F.concat_ws(" ", "tokens").alias("words"))
    rows = titles.unionByName(blanks)
    return classify.score_labels(rows, models, tokens="words", key="model").select("fid", "model", "label", _prob())


@query
def score_plugin(spark, sf_dir):
    """A user's model that fails on short texts and has no answer to very long
    ones; some texts are null, some blank."""

    def load():
        return {"long": 2000, "failing": 400, "too_long": 5000}

    def score(model, words):
        if len(words) < model["failing"]:
            raise ValueError("too short")
        if len(words) > model["too_long"]:
            return None
        return ("long" if len(words) > model["long"] else "short", 1.0 / len(words))

    given = F.when(F.col("doc_id") % 50 == 0, None).when(F.col("doc_id") % 50 == 1, " \t").otherwise(F.col("text"))
    rows = data.documents(spark, sf_dir).select(F.col("doc_id").alias("fid"), given.alias("words"))
    return classify.score_with(rows, load, score).select("fid", "label", F.round("prob", 9).alias("prob"))


@query
def parent_labels(spark, sf_dir):
    tokens, models = _words_and_models(spark, sf_dir)
    scored = classify.parent_labels(tokens, models, column="content_tokens")
    return scored.select("fid", text.join_tokens(F.col("content_tokens")).alias("words"), "cat", _prob())


def _children(tokens, models, column):
    parents = classify.parent_labels(tokens, models, column=column)
    return classify.child_labels(parents, models, data.LISTED, column=column, keep_words=False)


@query
def child_labels(spark, sf_dir):
    return _children(*_words_and_models(spark, sf_dir), "content_tokens").select("fid", "cat", _prob())


@query
def union_all_labels(spark, sf_dir):
    tokens, models = _words_and_models(spark, sf_dir)
    sides = [_children(tokens, models, column) for column in ("title_tokens", "content_tokens")]
    return classify.union_labels(*sides).select("fid", "cat", _prob())


def _labels(spark, sf_dir):
    tokens, models = _words_and_models(spark, sf_dir)
    return label_articles(tokens, models, models, data.LISTED, ("fid",))


# Assembly and decision

_PROBS = ("title_pprob", "title_cprob", "content_pprob", "content_cprob")


def _rounded(df):
    return df.select(*[_prob(c) if c in _PROBS else F.col(c) for c in df.columns])


@query
def assemble_labels(spark, sf_dir):
    """Four label tables, each scored by itself, brought together."""
    tokens, models = _words_and_models(spark, sf_dir)
    sides = []
    for column in ("title_tokens", "content_tokens"):
        parents = classify.parent_labels(tokens, models, column=column)
        sides += [parents, classify.child_labels(parents, models, data.LISTED, column=column, keep_words=False)]
    return _rounded(assemble.assemble_labels(*sides))


def _assembled(spark, sf_dir):
    """Articles of the wanted sources with hashes and labels."""
    rows = tables.keep_sources(data.crawl(spark, sf_dir), data.SOURCES)
    labels = _labels(spark, sf_dir)
    return assemble.assemble_articles(rows, data.hashes(spark, sf_dir), labels, data.RULES)


@query
def assemble_articles(spark, sf_dir):
    return _rounded(_assembled(spark, sf_dir))


@query
def site_label(spark, sf_dir):
    rows = data.pages(spark, sf_dir).select("page_id", urls.site(F.col("url")).alias("furl"))
    return rows.select("page_id", urls.site_label(F.col("furl"), data.LABEL_RULES).alias("site_label"))


@query
def title_only_site(spark, sf_dir):
    rows = data.pages(spark, sf_dir).select("page_id", urls.site(F.col("url")).alias("furl"))
    return rows.select("page_id", urls.title_only(F.col("furl"), data.TITLE_ONLY).alias("is_title_only"))


@query
def site_label_table(spark, sf_dir):
    """The label of the one host in a page's URL, from a table of all hosts."""
    rows = data.pages(spark, sf_dir).select("page_id", F.col("url").alias("furl"))
    return rule_tables.site_label(rows, data.host_rules(spark, sf_dir)).select("page_id", "site_label")


@query
def title_only_table(spark, sf_dir):
    rows = data.pages(spark, sf_dir).select("page_id", F.col("url").alias("furl"))
    hosts = data.host_patterns(spark, sf_dir, data.TITLE_LANG)
    return rule_tables.title_only(rows, hosts).select("page_id", "is_title_only")


@query
def final_label(spark, sf_dir):
    """The decision alone: labels of all articles, no row rule before it."""
    articles = decide.with_site_rules(
        assemble.assemble_articles(
            data.crawl(spark, sf_dir), data.hashes(spark, sf_dir), _labels(spark, sf_dir), data.RULES
        ),
        data.RULES,
    )
    return _rounded(decide.final_label(articles))


# Runs


@query
def article_labels_run(spark, sf_dir):
    """From crawl to published table as one plan."""
    return _rounded(publish(_assembled(spark, sf_dir), data.RULES, extra=()))


@query
def sink_empty_day(spark, sf_dir):
    """Write all days, then the first ten again without their odd ids, and the
    fifth without a row."""
    path = new_path(spark, "sink")
    rows = data.crawl(spark, sf_dir).select("fid", "src_type", DAY)
    tables.write_days(rows, path, FIRST_DAY, rebalance=True, end=LAST_DAY_EXCLUSIVE)
    again = rows.where((F.col(DAY) < "20240111") & (F.col("fid") % 2 == 0) & (F.col(DAY) != "20240105"))
    tables.write_days(again, path, FIRST_DAY, rebalance=True, end="20240111")
    back = tables.read_days(spark, path, FIRST_DAY, LAST_DAY_EXCLUSIVE)
    return back.groupBy(DAY).agg(F.count("*").alias("n"), F.sum("fid").alias("sum_fid"))


@query
def repeated_ids(spark, sf_dir):
    """The crawl with some articles given twice, the second time with the title
    as the text: each row has its own hash and label."""
    tokens, models = _words_and_models(spark, sf_dir)
    first = tokens.select("fid", F.lit(0).alias("of"), F.col("content_tokens").alias("tokens"))
    second = tokens.where(F.col("fid") % 3 == 0).select("fid", F.lit(1).alias("of"), F.col("title_tokens").alias("tokens"))
    rows = first.unionByName(second).select("fid", "tokens")
    hashes = similarity.simhash64(rows, token_hash=hashing.md5_64)
    labels = classify.score_labels(rows, models)
    return classify.union_labels(
        hashes.select("fid", F.col("hash").cast("string").alias("value")), labels.select("fid", F.col("label").alias("value"))
    )


@query
def repeated_ids_keywords(spark, sf_dir):
    """Keywords of articles given twice, the second time with the title as the
    text: each row keeps its own, and has a hash of its own."""
    tokens, _ = _words_and_models(spark, sf_dir)
    first = tokens.select("fid", F.col("content_tokens").alias("tokens"))
    second = tokens.where(F.col("fid") % 3 == 0).select("fid", F.col("title_tokens").alias("tokens"))
    rows = stage(first.unionByName(second), "twice")
    lexicon = data.lexicon(spark, sf_dir)
    kept = words.keywords(rows, lexicon).select("fid", F.concat_ws(" ", "tokens").alias("value"))
    hashes = similarity.simhash_keywords(rows, lexicon, token_hash=hashing.md5_64)
    return classify.union_labels(kept, hashes.select("fid", F.col("hash").cast("string").alias("value")))


def _duplicates(spark, sf_dir, crawl, threshold):
    store = tables.StageStore(spark, new_path(spark, "store"))
    report = run_duplicates(
        store,
        crawl,
        FIRST_DAY,
        LAST_DAY_EXCLUSIVE,
        rules=data.RULES,
        sources=data.SOURCES,
        drop_script=data.NOT_LETTERS,
        threshold=threshold,
        token_hash=hashing.md5_64,
    )
    return store, report.select(DAY, "fid", "hash", "samelen", "furl", "ftitle", "fcontent_len", "src_type")


@query
def duplicate_run(spark, sf_dir):
    """All days through every table of the duplicate run; days do not mix."""
    return _duplicates(spark, sf_dir, data.crawl(spark, sf_dir), 2)[1]


@query
def duplicate_run_none(spark, sf_dir):
    """The default threshold, which no group of these days reaches."""
    return _duplicates(spark, sf_dir, data.crawl(spark, sf_dir), fixed.DUPLICATE_THRESHOLD)[1]


@query
def duplicate_run_day(spark, sf_dir):
    """Everything in one day."""
    return _duplicates(spark, sf_dir, data.crawl(spark, sf_dir).withColumn(DAY, F.lit(FIRST_DAY)), 2)[1]


@query
def run_near_members(spark, sf_dir):
    """The member strings of near groups that a run over one day wrote."""
    store, _ = _duplicates(spark, sf_dir, data.crawl(spark, sf_dir).withColumn(DAY, F.lit(FIRST_DAY)), 2)
    rows = store.read(fixed.NEAR_MEMBERS, FIRST_DAY, LAST_DAY_EXCLUSIVE)
    return rows.select("leader", "samelen", "part", "samefid")


def _ranged(spark, sf_dir, steps=("duplicates", "labels", "articles"), models=None):
    """The backfill of the month."""
    crawl_path = new_path(spark, "crawl")
    tables.write_days(data.crawl(spark, sf_dir), crawl_path)
    store = tables.StageStore(spark, new_path(spark, "store"))
    models = models or _words_and_models(spark, sf_dir)[1]
    duplicates = dict(drop_script=data.NOT_LETTERS, threshold=2, token_hash=hashing.md5_64)
    run_range(
        store, crawl_path, FIRST_DAY, LAST_DAY_EXCLUSIVE, models, models,
        rules=data.RULES, sources=data.SOURCES, listed=data.LISTED, steps=steps, **duplicates,
    )
    return store


@query
def label_range(spark, sf_dir):
    """Rows per day of the backfill's tables."""
    store = _ranged(spark, sf_dir)
    counts = [
        store.read(name, FIRST_DAY, LAST_DAY_EXCLUSIVE)
        .groupBy(DAY)
        .agg(F.count("*").alias("n"), F.sum("fid").alias("sum_fid"))
        .withColumn("stage", F.lit(name))
        for name in (fixed.HASHES, fixed.REPORT, fixed.UNION, fixed.PUBLISHED)
    ]
    return classify.union_labels(*counts)


@query
def run_union_cat(spark, sf_dir):
    """The union of labels as the backfill stored it."""
    return _rounded(_ranged(spark, sf_dir, ("labels",)).read(fixed.UNION, FIRST_DAY, LAST_DAY_EXCLUSIVE))


@query
def run_etl(spark, sf_dir):
    """The published table as the backfill stored it."""
    return _rounded(_ranged(spark, sf_dir).read(fixed.PUBLISHED, FIRST_DAY, LAST_DAY_EXCLUSIVE))


@query
def label_run_plugin(spark, sf_dir):
    """The label run with a user's own model on both levels: the language of the
    first word's length, then whether the parent's texts are long."""

    def score(model, words, parent=None):
        if parent is None:
            return (model[len(words.split()[0]) % 4], 0.75)
        return None if parent == "fr" else (f"{parent}/{'long' if len(words) > 1000 else 'short'}", 0.25)

    plugin = classify.Plugin(lambda: ("de", "en", "fr", "es"), score)
    return _ranged(spark, sf_dir, ("labels",), plugin).read(fixed.UNION, FIRST_DAY, LAST_DAY_EXCLUSIVE)
