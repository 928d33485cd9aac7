"""Rule files, daily tables and the shared folder."""

import random

import pytest
from pyspark.sql import functions as F

from pagesift import fixed, schemas, session
from pagesift.operators import decide, filters, rule_tables
from pagesift.plans import duplicates
from pagesift.sources import rules, tables
from pagesift.testbed import data


def test_rule_lines(spark, tmp_path):
    path = tmp_path / "useless.txt"
    path.write_text("a.com\n\n  \t\n b.com \nc.com")
    assert rules.patterns(rules.load_rules(spark, str(path))) == [" b.com ", "a.com", "c.com"]


def test_label_rules(spark, tmp_path):
    path = tmp_path / "labels.txt"
    path.write_text("a.com\told\nb.com  \t two\r\n\nc.com\n x.com y\nd.com one two\na.com new\ne.com\tlast \n", newline="")
    got = rules.label_pairs(rules.load_label_rules(spark, str(path)))
    assert got == [("a.com", "new"), ("b.com", "two"), ("e.com", "last")]


def test_label_rules_come_from_one_file(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.txt").write_text("x.com label")
    with pytest.raises(ValueError):
        rules.load_label_rules(spark, str(tmp_path))


def test_long_lists_stay_tables(spark):
    urls = ["http://a.com/x", "http://bad.org/", None, "", "http://ok.de/bad.net"]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls * 3)], "fid long, furl string")
    listed = spark.createDataFrame([("bad.",), ("nowhere",), ("a.com/x",)], "pattern string")
    got = sorted(r.fid for r in rule_tables.not_listed(rows, listed).collect())
    assert got == [i for i, u in enumerate(urls * 3) if not any(p in (u or "") for p in ("bad.", "nowhere", "a.com/x"))]
    assert rule_tables.not_listed(rows, listed.where("pattern = 'x'")).count() == len(urls) * 3


def test_tables_of_many_rules(spark):
    """Fifty thousand rules on all three uses, against a look at each."""
    r = random.Random(1)
    hosts = sorted({"".join(r.choice("abcdefghij.") for _ in range(r.randrange(1, 12))) for _ in range(60_000)})[:50_000]
    labels = [(h, r.choice(["sport", "news"])) for h in hosts]
    urls = [None, "", "x", "http://zzzz/"] + ["http://" + "".join(r.choice("abcdefghij./z") for _ in range(r.randrange(9))) + "/z" for _ in range(200)]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls + urls)], "fid long, furl string")
    table = spark.createDataFrame(labels, "host string, label string").repartition(8)
    patterns = table.selectExpr("host AS pattern").unionByName(spark.createDataFrame([(None,), ("",)], "pattern string"))
    known = dict(labels)
    hits = {u: [h for h in hosts if h in u] for u in urls if u}
    long = {u: [h for h in of if len(h) > 4] for u, of in hits.items()}
    got = rule_tables.with_site_rules(rows, table, patterns.where("length(pattern) > 4"))
    want = sorted((i, known[hits[u][0]] if u and len(hits[u]) == 1 else "", bool(u and long[u])) for i, u in enumerate(urls + urls))
    assert sorted(tuple(x) for x in got.select("fid", "site_label", "is_title_only").collect()) == want
    assert any(label for _, label, _ in want) and any(t for *_, t in want)
    kept = sorted(x.fid for x in rule_tables.not_listed(rows, patterns).collect())
    assert kept == [i for i, u in enumerate(urls + urls) if not u or not hits[u]]
    none = patterns.where("false")
    assert rule_tables.not_listed(rows, none).count() == len(urls) * 2
    assert rule_tables.title_only(rows, none).where("is_title_only").count() == 0


def test_rule_files_to_decision(spark, tmp_path):
    (tmp_path / "useless.txt").write_text("bad.org\n\n")
    (tmp_path / "labels.txt").write_text("a.com sport\n")
    made = filters.Rules(
        useless=rules.patterns(rules.load_rules(spark, str(tmp_path / "useless.txt"))),
        label_rules=rules.label_pairs(rules.load_label_rules(spark, str(tmp_path / "labels.txt"))),
    )
    articles = spark.createDataFrame(
        [(1, "http://a.com/", "t", "body"), (2, "http://bad.org/", "t", "body")], "fid long, furl string, ftitle string, fcontent string"
    )
    kept = decide.with_site_rules(filters.drop_unusable(articles, made), made).collect()
    assert [(r.fid, r.site_label) for r in kept] == [(1, "sport")]


def test_empty_tables_and_days(spark, tmp_path):
    store = tables.StageStore(spark, str(tmp_path))
    rows = spark.createDataFrame([(1, 5, "20240101"), (2, 6, "20240102"), (3, 7, "20240104")], "fid long, hash long, stat_date string")
    store.write(fixed.HASHES, rows.where("fid < 0"), "20240101", "20240105")
    assert store.read(fixed.HASHES, "20240101", "20240105").count() == 0
    store.write(fixed.HASHES, rows, "20240101", "20240105")
    # A day that is written again without a row is empty, days outside stay.
    store.write(fixed.HASHES, rows.where("fid = 2"), "20240101", "20240104")
    assert sorted(r.fid for r in store.read(fixed.HASHES, "20240101", "20240105").collect()) == [2, 3]
    store.write(fixed.HASHES, rows.where("fid < 0").drop("stat_date"), "20240102")
    assert [r.fid for r in store.read(fixed.HASHES, "20240101", "20240105").collect()] == [3]


def test_days(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "20240101"), (2, "20240102"), (3, "20240103")], "fid long, stat_date string")
    tables.write_days(rows, path)
    # One day again: the others stay, and writing twice changes nothing.
    for _ in range(2):
        tables.write_days(spark.createDataFrame([(9,), (8,)], "fid long"), path, "20240102")
    back = tables.read_days(spark, path, "20240101", "20240104")
    assert dict(back.dtypes)["stat_date"] == "string"
    assert sorted((r.fid, r.stat_date) for r in back.collect()) == [
        (1, "20240101"), (3, "20240103"), (8, "20240102"), (9, "20240102"),
    ]
    assert tables.read_days(spark, path, "20240102").count() == 2
    assert tables.read_days(spark, path, "20240101", "20240103").count() == 3
    assert tables.drop_day(back).columns == ["fid"]


class Stopped(Exception):
    pass


@pytest.mark.parametrize("stop_at", ["_write_whole", "_finish", "remove", "second day"])
def test_days_change_all_or_none(spark, tmp_path, monkeypatch, stop_at):
    """A write that stops anywhere leaves the old days, or is finished later."""
    path = str(tmp_path / "days")
    old = {(1, "20240101"), (2, "20240102"), (3, "20240103"), (4, "20240105")}
    new = {(7, "20240101"), (8, "20240102"), (4, "20240105")}
    tables.write_days(spark.createDataFrame(sorted(old), "fid long, stat_date string"), path)
    rows = spark.createDataFrame([(7, "20240101"), (8, "20240102")], "fid long, stat_date string")
    read = lambda: {tuple(r) for r in tables.read_days(spark, path, "20240101", "20240201", ["fid", "stat_date"]).collect()}

    def stop(*_):
        raise Stopped

    with monkeypatch.context() as patch:
        if stop_at == "second day":
            own = tables.file_system

            def one_rename(spark, path):
                fs, at = own(spark, path)
                done = []

                class Once:
                    def __getattr__(self, name):
                        return getattr(fs, name)

                    def rename(self, a, b):
                        if done:
                            raise Stopped
                        if f"{tables._NEW}" in a.toString():
                            done.append(a)
                        return fs.rename(a, b)

                return Once(), at

            patch.setattr(tables, "file_system", one_rename)
        else:
            patch.setattr(tables, stop_at, stop)
        with pytest.raises(Stopped):
            tables.write_days(rows, path, "20240101", end="20240104")
    if stop_at in ("_write_whole", "_finish"):
        assert read() == old
    tables.recover_days(spark, path, "20240105")  # no day of that write
    before = read()
    tables.recover_days(spark, path, clean=True)
    assert read() == (old if stop_at == "_write_whole" else new)
    assert stop_at not in ("remove", "second day") or before != new
    tables.write_days(rows, path, "20240101", end="20240104")
    assert read() == new
    assert not [n for n in tables._names(spark, path) if n.startswith((tables._COMMIT, tables._NEW))]


def test_the_next_write_finishes_a_stopped_one(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "days")
    both = spark.createDataFrame([(1, "20240101"), (2, "20240102")], "fid long, stat_date string")
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_finish", lambda *_: (_ for _ in ()).throw(Stopped()))
        with pytest.raises(Stopped):
            tables.write_days(both, path)
    tables.write_days(spark.createDataFrame([(9,)], "fid long"), path, "20240102")
    assert {tuple(r) for r in tables.read_days(spark, path, "20240101", "20240103", ["fid", "stat_date"]).collect()} == {
        (1, "20240101"), (9, "20240102"),
    }


def test_a_failed_run_goes_on_after_its_last_step(spark, sf_dir, tmp_path, monkeypatch):
    crawl_path, day = str(tmp_path / "crawl of 100 %"), "20240101"
    tables.write_days(data.crawl(spark, sf_dir), crawl_path)
    options = dict(rules=data.RULES, sources=data.SOURCES, drop_script=data.NOT_LETTERS, threshold=1)
    written = []
    own = tables.write_days

    def count(df, path, *args):
        name = path.rsplit("/", 1)[1]
        if fail and name == fixed.EXACT_MEMBERS:
            raise Stopped
        written.append(name)
        own(df, path, *args)

    def run(name="first"):
        written.clear()
        store = tables.StageStore(spark, str(tmp_path / "store"), name)
        return duplicates.run_duplicates(store, tables.read_crawl(spark, crawl_path, day), day, **options).collect()

    monkeypatch.setattr(tables, "write_days", count)
    fail = True
    with pytest.raises(Stopped):
        run()
    assert written == [fixed.KEYWORDS, fixed.HASHES, fixed.EXACT]
    fail = False
    rows = run()
    assert rows and written[0] == fixed.EXACT_MEMBERS and not {fixed.KEYWORDS, fixed.HASHES, fixed.EXACT} & set(written)
    again = run()
    assert not written and sorted(map(str, again)) == sorted(map(str, rows))
    # Another day of the crawl changes nothing; this day's rows, or other rules, do.
    own(data.crawl(spark, sf_dir).where("stat_date = '20240102'"), crawl_path, "20240102")
    run()
    assert not written
    own(data.crawl(spark, sf_dir).where(f"stat_date = '{day}'"), crawl_path, day)
    run()
    assert fixed.KEYWORDS in written and fixed.REPORT in written


def test_day_prunes_partitions(spark, sf_dir, tmp_path):
    path = str(tmp_path / "crawl")
    tables.write_days(data.crawl(spark, sf_dir), path)
    one = tables.read_crawl(spark, path, "20240105")
    plan = one.select("fid")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stat_date" in plan
    assert "ReadSchema: struct<fid:bigint>" in plan
    assert len(one.inputFiles()) >= 1
    assert one.count() == data.crawl(spark, sf_dir).where("stat_date = '20240105'").count()


def test_whitelist_and_limit(spark, sf_dir):
    rows = data.crawl(spark, sf_dir)
    assert {r[0] for r in tables.keep_sources(rows, ["src1"]).select("src_type").distinct().collect()} == {"src1"}
    assert tables.keep_sources(rows).count() == 0
    assert [r.fid for r in tables.debug_limit(rows, 3).orderBy("fid").collect()] == [0, 1, 2]


def test_crawl_schema(spark, sf_dir):
    checked = schemas.conform(data.crawl(spark, sf_dir), schemas.CRAWL, "stat_date")
    assert checked.count() == 200
    with pytest.raises(TypeError):
        schemas.conform(checked.withColumn("fid", F.col("fid").cast("int")), schemas.CRAWL)


class _Session:
    """What ``shared_dir`` asks a session for."""

    def __init__(self, master, named=None):
        self.settings = {session.CHECKPOINT_CONF: named, session.WAREHOUSE_CONF: "/warehouse/"}
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.applicationId = f"{master}-{named}"

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def getConf(self):
        return self


def test_shared_dir_is_the_named_one():
    assert session.shared_dir(_Session("spark://x", "s3://bucket/tmp/")) == "s3://bucket/tmp"
    assert session.shared_dir(_Session("local[2]")) == "/warehouse"
    with pytest.raises(RuntimeError):
        session.shared_dir(_Session("spark://x"))


def test_stage_reads_back_what_was_written(spark):
    staged = session.stage(spark.range(5).toDF("x"), "five")
    assert staged.count() == 5
    session.clear_stages(spark)
    staged = session.stage(spark.range(5).toDF("x"), "five")
    assert staged.inputFiles()[0].removeprefix("file:").lstrip("/").startswith(session.shared_dir(spark).removeprefix("file:").lstrip("/"))
