"""Operators on hand-written rows: edge cases and published worked examples."""

import io
import json
import zipfile
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from caselake import shared
from caselake.functions.text import clean_name, partial_date, pieces, surrogate_key
from caselake.operators import identity, measures, pairs, serving, staging, star, versions
from caselake.plans import dag
from caselake.sources import eras, extracts, remote


def test_clean_name(spark):
    cases = {
        "ASPIRIN (ACETYLSALICYLIC ACID)": "ASPIRIN", "DRUG (UNCLOSED": "DRUG", "THYMOGLOBULIN (RABBIT)": "THYMOGLOBULIN RABBIT",
        "IODINE ( I-131 )": "IODINE I-131", "PRED.": "PRED", "X  TABLETS": "X", "Y 10 MG": "Y", "INTERFERON 2B": "INTERFERON 2B", "(ALL)": None, "Z 0.5/2 %": "Z",
    }
    df = spark.createDataFrame(list(cases.items()), "raw string, want string").withColumn("got", clean_name(F.col("raw")))
    assert all(r.got == r.want for r in df.collect()), df.collect()


def test_partial_date(spark):
    cases = {"20120305": date(2012, 3, 5), "201203": date(2012, 3, 1), "2012": date(2012, 1, 1), "20150230": None, "2015031": None, "": None, "abcd": None, None: None}
    df = spark.createDataFrame(list(cases.items()), "raw string, want date").withColumn("got", partial_date(F.col("raw")))
    assert all(r.got == r.want for r in df.collect()), df.collect()


def test_surrogate_key(spark):
    row = spark.range(1).select(surrogate_key(F.lit("rxcui:9143")).alias("k")).first()
    assert row.k == "c09036bcbf72a13c997c5be9c68aa167"


def test_pieces(spark):
    df = spark.createDataFrame([("a\\b OR c AND OR  d \\\\e",)], "s string")
    assert df.select(pieces(F.col("s"))).first()[0] == ["A", "B", "C", "D", "", "E"]


def test_measures_worked_example(spark):
    cells = [("x", "r", 20775, 19668, 34035, 20510241, 0, 10, 10, 0), ("y", "r", 3, 5, 10**6, 10**9, 3, 5, 10**6, 10**9)]
    table = spark.createDataFrame(cells, "identity_key string, reaction_pt string, a long, b long, c long, d long, a_nolw long, b_nolw long, c_nolw long, d_nolw long")
    series = spark.createDataFrame([("x", "r", date(2020, 4, 1), 7, 1), ("x", "r", date(2019, 1, 1), 7, 2)], "identity_key string, reaction_pt string, report_quarter date, n_cases long, n_cases_nolw long")
    row = measures.signals(table, series).where("identity_key = 'x'").first()
    assert (row.n, row.peak_quarter, row.peak_quarter_n) == (20584719, date(2019, 1, 1), 7)
    assert row.expected == pytest.approx(107.686, abs=1e-3) and row.ic == pytest.approx(7.58523, abs=1e-5) and row.ic025 == pytest.approx(7.56233, abs=1e-5)
    assert measures.prr(table).where("identity_key = 'x'").first().prr == pytest.approx(310.072, abs=1e-3)
    assert measures.ror(table).count() == 2


def test_no_reports_without_lawyers(spark):
    table = spark.createDataFrame([("x", "r", 3, 1, 1, 1, 0, 0, 0, 0)], "identity_key string, reaction_pt string, a long, b long, c long, d long, a_nolw long, b_nolw long, c_nolw long, d_nolw long")
    series = spark.createDataFrame([], "identity_key string, reaction_pt string, report_quarter date, n_cases long, n_cases_nolw long")
    row = measures.signals(table, series).first()
    assert row.pct_lw == 1.0 and row.expected_nolw != row.expected_nolw and row.peak_quarter is None


def test_rule_cascade(spark):
    totals = spark.createDataFrame([(p, 1) for p in ("SEEDED", "ONE", "PICK", "MANY", "DEVICE", "GUM NOS", "OTHER", "")], "piece string, n_rows long")
    seed = spark.createDataFrame([("SEEDED", "rxcui:1", "rxnorm", "PIN")], "piece string, identity string, identity_source string, tty string")
    rxcui = spark.createDataFrame([("SEEDED", "9"), ("ONE", "9"), ("PICK", "10"), ("MANY", "11"), ("OTHER", None)], "piece string, rxcui string")
    related = spark.createDataFrame([("9", "90", "one"), ("10", "91", "pick"), ("10", "92", "other"), ("11", "93", "a"), ("11", "94", "b")], "rxcui string, in_rxcui string, in_name string")
    got = {r.piece: (r.identity, r.status, r.rule_rank) for r in identity.piece_identity(totals, seed, rxcui, related).collect()}
    assert got == {
        "SEEDED": ("rxcui:1", "matched", 1), "ONE": ("rxcui:90", "matched", 2), "PICK": ("rxcui:91", "matched", 3), "MANY": (None, "ambiguous", 3),
        "DEVICE": (None, "non_specific", 4), "GUM NOS": (None, "non_specific", 4), "OTHER": ("local:OTHER", "unmatched", 6), "": ("local:", "unmatched", 6),
    }


def test_bands(spark):
    rows = [("few", "A")] * 3 + [("pure", "A")] * 40 + [("pure", "B")] * 2 + [("mostly", "A")] * 9 + [("mostly", "B")] + [("mixed", "A")] * 5 + [("mixed", "B")] * 5 + [("mixed", None)] * 9
    df = spark.createDataFrame(rows, "drugname_clean string, prod_ai string")
    got = {r.drugname_clean: (r.band, r.modal_ai) for r in identity.name_lookup(df).collect()}
    assert got == {"few": ("low_support", "A"), "pure": ("pure", "A"), "mostly": ("mostly", "A"), "mixed": ("ambiguous", "B")}


def test_contingency_margins(spark):
    rows = [(str(i), k, r, i % 3 == 0, None) for i in range(40) for k in ("d1", None, "d2")[: 1 + i % 3] for r in ("r1", "r2")[: 1 + i % 2]]
    df = spark.createDataFrame(rows, "primaryid string, identity_key string, reaction_pt string, is_lw boolean, report_quarter date")
    n = len({r[0] for r in rows})
    assert all(r.a + r.b + r.c + r.d == n and r.a_nolw <= r.a for r in pairs.contingency(df).collect())


def test_versions_keep_one_row_a_case(spark):
    demo = spark.createDataFrame([("1", "c", "2", None), ("2", "c", "10", "x"), ("10", "c", "10", "x"), ("5", "d", None, None), ("6", "d", "bad", "y"), ("7", None, "1", "z")], "primaryid string, caseid string, caseversion string, sex string")
    drug = spark.createDataFrame([("10", "a"), ("2", "b"), ("10", "c")], "primaryid string, drugname string")
    cleaned = versions.clean(demo, "demo", spark.createDataFrame([("zzz",), (None,)], "caseid string"))
    keep = {r.caseid: r.primaryid for r in versions.keep_list(cleaned, {"drug": drug}).collect()}
    assert keep == {"c": "10", "d": "6"}
    kept = versions.dedup({"demo": cleaned, "drug": drug}, versions.keep_list(cleaned, {"drug": drug}))
    assert kept["demo"].count() == 2 and kept["drug"].count() == 2


def test_repair(spark, tmp_path):
    path = str(tmp_path / "demo.txt")
    lines = ["ID $A$B", "1$x$y", "2$x$y$ ", "3$x$y4$x$y", "5$p$q$6$r$s", "7$only", ""]
    (tmp_path / "demo.txt").write_text("\r\n".join(lines))
    with pytest.raises(PySparkException):
        extracts.read_delimited(spark, path, ["ID ", "A", "B"]).collect()
    (tmp_path / "demo.txt").write_text("\r\n".join(x for x in lines if not x.startswith("3")))
    got = sorted((r.ID, r.A, r.B) for r in extracts.read_delimited(spark, path, ["ID ", "A", "B"]).collect())
    assert got == [("1", "x", "y"), ("2", "x", "y"), ("5", "p", "q"), ("6", "r", "s"), ("7", "only", None)]
    with pytest.raises(extracts.BrokenExtract):
        extracts.check_line_ends(b"a\rb\r\nc\n")


def test_glued_records_with_a_rest(spark, tmp_path):
    """A line of two headers' width or more is always parted; what the last record has too much is cut by the scan."""
    (tmp_path / "x.txt").write_text("1$a$b$2$c$d$e$f\n3$g$h$4$i$j$5$k$l$ \n")
    got = sorted(tuple(r) for r in extracts.read_delimited(spark, str(tmp_path / "x.txt"), ["id", "x", "y"]).collect())
    assert got == [("1", "a", "b"), ("2", "c", "d"), ("3", "g", "h"), ("4", "i", "j"), ("5", "k", "l")]


def _zip(path, **members):
    with zipfile.ZipFile(path, "w") as z:
        for name, body in members.items():
            z.writestr(name.replace("__", "/") + ".txt", body)
    return str(path)


def test_read_archives(spark, tmp_path):
    head = "ISR$CASE$" + "$".join(f"f{i}" for i in range(10))
    line = "8129732$" + "$".join(str(i) for i in range(1, 13))
    archives = {
        "2012q1": _zip(tmp_path / "a.zip", ascii__DEMO12Q1=f"{head}\r\n{line}\r\n1$2\r\n\r\n", ascii__demo12q1_new="ISR$CASE\n5$6$ \n7$8$9$10"),
        "2020q2": _zip(tmp_path / "b.zip", DEMO20Q2="primaryid$caseid$sex \n11$12$F", deleted__delete20q2="4\n\n 4 \n"),
    }
    rows = {(r.quarter, r.primaryid): r for r in extracts.read_archives(spark, archives, "demo").collect()}
    assert set(rows) == {("2012q1", x) for x in ("8129732", "1", "5", "7", "9")} | {("2020q2", "11")}
    assert rows["2012q1", "8129732"].f7 == "9\uff0410" and rows["2012q1", "8129732"].f9 == "12" and rows["2012q1", "1"].f0 is None
    assert rows["2020q2", "11"].sex == "F" and rows["2020q2", "11"].f0 is None and rows["2012q1", "9"].caseid == "10"
    assert [r.caseid for r in extracts.read_deleted(spark, archives).collect()] == ["4"]
    with pytest.raises(extracts.BrokenExtract):
        extracts.read_archives(spark, archives, "ther")
    bare = {"2012q1": _zip(tmp_path / "c.zip", DEMO12Q1="ISR$CASE\r\n1$2\r\n3\r$4\n")}
    with pytest.raises(PySparkException):
        extracts.read_archives(spark, bare, "demo").collect()
    unknown = {"2012q1": _zip(tmp_path / "d.zip", DEMO12Q1="ISR$CASE\n1$2$3$x\n1$2$3\n")}
    with pytest.raises(PySparkException):
        extracts.read_archives(spark, unknown, "demo").collect()


def test_remote(tmp_path):
    asked = []

    def fetch(url):
        asked.append(url)
        yield b"zip"
        if len(asked) == 1:
            raise OSError("broken off")

    with pytest.raises(OSError):
        remote.download("2012q3", str(tmp_path), "https://example.org/exports/", fetch)
    place = remote.download("2012q3", str(tmp_path), "https://example.org/exports/", fetch)
    assert remote.download("2012q3", str(tmp_path), "https://example.org/exports/", fetch) == place and open(place, "rb").read() == b"zip"
    assert asked == ["https://example.org/exports/aers_ascii_2012q3.zip"] * 2
    waits, answers = [], {"A": (200, {"x": 1}), "B": (500, {})}
    folder = str(tmp_path / "rxcui")
    assert remote.fetch_responses(["A", "B", "A"], folder, "piece", "v1", answers.get, waits.append) == {"fetched": 1, "failed": 1, "present": 1}
    assert waits == [remote.THROTTLE] * 2
    body = json.load(open(f"{folder}/6dcd4ce23d88e2ee9568ba546c007c63d9131c1b.json"))
    assert body == {"piece": "A", "rxnorm_version": "v1", "response": {"x": 1}}
    with pytest.raises(ValueError):
        remote.fetch_responses([], folder, "piece", "v2", answers.get, waits.append)


def test_staged_tables_go_with_their_scope(spark):
    df = spark.range(3)
    with shared.scope() as outer:
        a = shared.stage(df, "a")
        with shared.scope() as inner:
            b, c = shared.stage(df, "b"), shared.stage(df, "c")
            inner.keep(c)
        assert shared.is_staged(a) and not shared.is_staged(b) and shared.is_staged(c)
        outer.keep(a)
    assert a.count() == 3 and not shared.is_staged(c)
    shared.drop_staged(a)
    assert not shared.is_staged(a)


def test_machine_local_folder_is_refused_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Undefined:
        def isDefined(self):
            return False

    class Session:
        conf, sparkContext = {}, Context()

    Context._jsc = type("Java", (), {"sc": lambda self: type("Scala", (), {"getCheckpointDir": lambda self: Undefined()})()})()
    with pytest.raises(RuntimeError):
        shared.shared_dir(Session())


def test_dedup_keeps_clashing_names(spark):
    demo = spark.createDataFrame([("1", "c", "2", None, 5), ("1", "c", "2", "x", 4)], "primaryid string, caseid string, caseversion string, __rk string, gaps int")
    kept = versions.dedup({"demo": demo}, spark.createDataFrame([("c", "1")], "caseid string, primaryid string"))["demo"]
    assert kept.columns == demo.columns and kept.collect()[0]["__rk"] == "x" and kept.count() == 1


def test_embedded_delimiter(spark, tmp_path):
    head = [f"f{i}" for i in range(12)]
    (tmp_path / "x.txt").write_text("8129732$" + "$".join(str(i) for i in range(1, 13)) + "\n")
    row = extracts.read_delimited(spark, str(tmp_path / "x.txt"), head, "demo", "2012q1").first()
    assert (row.f9, row.f10, row.f11) == ("9＄10", "11", "12")


def test_archives_and_retractions(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("ascii/DEMO12Q4.txt", "a")
        z.writestr("ascii/demo12q4_b.TXT", "b")
        z.writestr("readme.txt", "c")
    assert extracts.members(buffer.getvalue(), "demo") == [b"a", b"b"]
    (tmp_path / "deleted.txt").write_text("\n 12 \r\n12\r\n7\n\n")
    assert {r.caseid for r in extracts.read_retractions(spark, str(tmp_path / "deleted.txt")).collect()} == {"12", "7"}


def test_eras(spark):
    old = spark.createDataFrame([("1", "2", "F")], "ISR string, `CASE` string, GNDR_COD string")
    assert eras.canonical(old, "demo", "2010q1").columns == ["primaryid", "caseid", "sex"]
    assert eras.canonical(spark.createDataFrame([("1", "L")], "primaryid string, LOT_NBR string"), "drug", "2012Q4").columns == ["primaryid", "lot_num"]
    assert eras.archive_name("2012Q3").startswith("aers") and eras.archive_name("2012q4").startswith("faers")
    assert eras.quarters(date(2005, 2, 1)) == [f"{y}q{q}" for y in (2004, 2005) for q in (1, 2, 3, 4)]
    with pytest.raises(ValueError):
        eras.quarter_key("2012q5")


def test_vocabulary(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"piece": "A", "rxnorm_version": "v", "response": {"idGroup": {"rxnormId": ["1", "2"]}}}))
    (tmp_path / "b.json").write_text(json.dumps({"piece": "B", "rxnorm_version": "v", "response": {"idGroup": {}}}, indent=1))
    got = sorted((r.piece, r.rxcui) for r in staging.stage_rxcui(extracts.read_vocabulary(spark, "rxcui", str(tmp_path))).collect() if r.rxcui) + [("B", None)]
    assert got == [("A", "1"), ("A", "2"), ("B", None)]
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "c.json").write_text(json.dumps({"rxcui": "1", "response": {"relatedGroup": {"conceptGroup": [{"tty": "IN"}, {"conceptProperties": [{"rxcui": "5", "name": "n", "tty": "IN"}]}]}}}))
    assert [tuple(r) for r in staging.stage_related(extracts.read_vocabulary(spark, "related", str(tmp_path / "r"))).collect()] == [("1", "5", "n", "IN")]


def test_sinks(spark, tmp_path):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    assert extracts.write_table(df, str(tmp_path / "t")) == 100 == extracts.write_table(df.limit(1), str(tmp_path / "t"))
    assert extracts.export_sorted(df, str(tmp_path / "s"), "k", "id") == 100 and spark.read.parquet(str(tmp_path / "s")).count() == 100
    other = spark.range(3).withColumn("extra", F.lit("x"))
    other.write.parquet(str(tmp_path / "o"))
    assert extracts.read_union(spark, str(tmp_path / "t"), str(tmp_path / "o")).where("extra is null").count() == 100


def test_star_and_serving(spark):
    outcomes = spark.createDataFrame([("1", "DE"), ("1", "XX"), ("2", None)], "primaryid string, outcome_code string")
    flags = {r.primaryid: (r.has_death, r.has_other_outcome) for r in star.outcome_flags(outcomes).collect()}
    assert flags == {"1": (1, 1), "2": (0, 0)}
    series = spark.createDataFrame([("k", "r", date(2003, 4, 1), 4, 4), ("k", "r", date(2004, 4, 1), 3, 1)], "identity_key string, reaction_pt string, report_quarter date, n_cases long, n_cases_nolw long")
    assert [(r.label, r.n, r.n_lw) for r in serving.quarter_series(series, "k", "r").orderBy("report_quarter").collect()] == [("2004 Q1", 0, 0), ("2004 Q2", 3, 2)]
    assert serving.cases_before(series, "k", "r").first().n_before == 4


def test_dag_order():
    order = dag.order("dim_drug")
    assert order.index("pairs") < order.index("contingency") < order.index("signals") < order.index("dim_drug")
