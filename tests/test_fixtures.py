"""Golden values on the hand-made accident files (FIXTURES.md section 2)."""

import pytest

from strata.operators import aggregate as agg
from strata.plans import accident_files, layers

CARAC = """Num_Acc;jour;mois;an;hrmn;lum;dep;atm;adr
202300000001;07;05;2023;06:00;1;75;2;Rue de l'été
202300000001;07;05;2023;06:00;1;75;2;Rue de l'été
202300000002;07;05;2023;19:30;7;2A;-1;x
;07;05;2023;19:30;7;01;1;x
   ;08;05;2023;10:00;1;01;1;x
202300000004;07;05;1999;09:30;7;01;1;x
202300000005;31;02;2023;9:30;7;01;1;x
202300000006;01;01;2005;23:59;1;01;1;x
202300000007;01;01;abc;12:00;1;75;1;x
"""
LIEUX = """Num_Acc;surf
202300000001;1
202300000001;2
202300000002;2
202300000005;1
202300000006;1
;1
"""
VEHICULES = """Num_Acc;num_veh;cat_veh
202300000001;A01;7
202300000002;A01;7
202300000002;B01;33
202300000005;A01;1
202300000006;A01;7
202300000006;A01;7
"""
USAGERS = """Num_Acc;num_veh;catu;sexe;grav
202300000001;A01;1;1;2
202300000001;A01;2;2;4
202300000001;A01;2;2;4
202300000002;A01;1;1;3
202300000002;B01;1;2;1
202300000005;A01;1;1;-1
202300000006;A01;1;2;4
202300000006;A01;3;1;
;A01;1;1;1
"""


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    d = tmp_path_factory.mktemp("bronze")
    out = {}
    for name, text in (("caracteristiques", CARAC), ("lieux", LIEUX),
                       ("vehicules", VEHICULES), ("usagers", USAGERS)):
        p = d / f"{name}.csv"
        p.write_bytes(text.encode("iso-8859-1"))
        out[name] = str(p)
    return out


@pytest.fixture(scope="module")
def raw(spark, paths):
    return accident_files.ingest(spark, paths)


@pytest.fixture(scope="module")
def silver(raw):
    return accident_files.clean_sources(raw)


def short(k):
    return k[-2:] if k else k


def test_missing_files_named_once(spark, paths):
    bad = dict(paths, lieux=paths["lieux"] + ".nope", usagers="/no/such/usagers.csv")
    with pytest.raises(FileNotFoundError) as e:
        accident_files.ingest(spark, bad)
    assert "lieux.csv.nope" in str(e.value) and "usagers.csv" in str(e.value)


def test_accent_read_in_latin1(spark, paths):
    from strata.sources import files
    adr = {r["adr"] for r in files.read_text_table(spark, paths["caracteristiques"]).collect()}
    assert "Rue de l'été" in adr


def test_clean_report(raw):
    rows = {r["table_name"]: r.asDict() for r in accident_files.cleaning_report(raw).collect()}
    a = rows["caracteristiques"]
    assert (a["raw_rows"], a["duplicate_rows"], a["rejected_key"], a["rejected_range"], a["kept_rows"]) == (9, 1, 2, 2, 4)
    assert (rows["lieux"]["raw_rows"], rows["lieux"]["rejected_key"], rows["lieux"]["kept_rows"]) == (6, 1, 5)
    assert (rows["vehicules"]["raw_rows"], rows["vehicules"]["duplicate_rows"], rows["vehicules"]["kept_rows"]) == (6, 1, 5)
    u = rows["usagers"]
    assert (u["raw_rows"], u["duplicate_rows"], u["rejected_key"], u["rejected_required"], u["kept_rows"]) == (9, 1, 1, 1, 6)
    for r in rows.values():  # each reason counted on its own
        assert r["raw_rows"] == (r["duplicate_rows"] + r["rejected_key"] + r["rejected_required"] + r["rejected_range"]
                                 + r["rejected_outlier"] + r["rejected_repeated_key"] + r["kept_rows"])


def test_kept_accidents_and_hours(silver):
    got = {short(r["num_acc"]): r["heure_int"] for r in silver["accidents"].collect()}
    assert got == {"01": 6, "02": 19, "05": None, "06": 23}


def test_leading_zero_and_corsica_codes_stay_text(silver):
    deps = sorted(r["dep"] for r in silver["accidents"].collect())
    assert deps == ["01", "01", "2A", "75"]


def test_impossible_date_is_null(silver):
    from strata.functions.expressions import date_from_parts
    r = {short(x["num_acc"]): x["d"] for x in
         silver["accidents"].select("num_acc", date_from_parts("an", "mois", "jour").alias("d")).collect()}
    assert r["05"] is None and r["06"] is not None


def test_severity_table(silver):
    got = {short(r["num_acc"]): (r["gravite_max"], r["nb_tues"], r["nb_hospitalises"], r["nb_usagers"],
                                 r["accident_grave"]) for r in silver["severity"].collect()}
    assert got["01"] == (4, 1, 0, 2, 1)
    assert got["02"] == (3, 0, 1, 2, 1)
    assert got["05"] == (None, 0, 0, 1, None)
    assert got["06"] == (2, 0, 0, 1, 0)


def test_by_weather(silver):
    got = {r["meteo"]: (r["nb_accidents"], r["gravite_moyenne"], r["total_tues"])
           for r in agg.severity_by_weather(silver["accidents"], silver["severity"]).collect()}
    assert got == {1: (2, 2.0, 0), -1: (1, 3.0, 0), 2: (1, 4.0, 1)}


def test_department_rank_with_tie_break(silver):
    rows = layers.top_departments(silver).orderBy("rang_dep").collect()
    assert [(r["dep"], r["taux_graves"], r["rang_dep"]) for r in rows] == [
        ("2A", 1.0, 1), ("75", 1.0, 2), ("01", 0.0, 3)]


def test_department_hour(silver):
    got = {(r["dep"], r["heure_int"]): r["nb_accidents"]
           for r in agg.department_hour(silver["accidents"], silver["places"]).collect()}
    assert got == {("01", 23): 1, ("01", None): 1, ("2A", 19): 1, ("75", 6): 1}


def test_weather_surface(silver):
    got = {(r["meteo"], r["etat_route"]): (r["nb_accidents"], r["nb_graves"])
           for r in agg.weather_surface(silver["accidents"], silver["places"], silver["severity"]).collect()}
    assert got == {(-1, 2): (1, 1), (1, 1): (2, 0), (2, 1): (1, 1), (2, 2): (1, 1)}


def test_skew_profile_fan_out(silver):
    got = {r["measure"]: (r["min_n"], r["max_n"], round(r["avg_n"], 4), round(r["ratio_max_avg"], 4))
           for r in agg.skew_profile(silver["accidents"], silver["places"]).collect()}
    assert got["joined_rows"] == (1, 2, 1.6667, 1.2)
    assert got["distinct_accidents"] == (1, 2, 1.3333, 1.5)


def test_older_layout_binds_by_name(spark, tmp_path):
    """A file whose columns are in another order binds by header name."""
    from strata import contracts
    from strata.sources import files
    text = "descr_grav;circ;catr;surf;atm;agglo;dep;heure;jour;an;Num_Acc\n3;1;2;1;2;1;75;06:00;07;2023;A1\n"
    p = tmp_path / "v1.csv"
    p.write_bytes(text.encode("iso-8859-1"))
    r = files.read_csv_contract(spark, str(p), contracts.CARACTERISTIQUES_V1).first()
    assert (r["Num_Acc"], r["an"], r["jour"], r["heure"], r["dep"]) == ("A1", 2023, "07", "06:00", "75")


def test_missing_contract_column_is_an_error(spark, tmp_path):
    from strata import contracts
    from strata.sources import files
    p = tmp_path / "bad.csv"
    p.write_bytes(b"Num_Acc;surf_typo\n1;2\n")
    with pytest.raises(contracts.ContractError, match="surf"):
        files.read_csv_contract(spark, str(p), contracts.LIEUX)


def test_decimal_comma_coordinates(spark, tmp_path):
    from strata import contracts
    from strata.sources import files
    p = tmp_path / "lieux_v1.csv"
    p.write_bytes("Num_Acc;com;dep;lat;long;catv\n1;75056;75;48,8566;2,3522;7\n2;x;75;n/a;;7\n".encode("iso-8859-1"))
    rows = {r["Num_Acc"]: (r["lat"], r["long"]) for r in files.read_csv_contract(spark, str(p), contracts.LIEUX_V1).collect()}
    assert rows == {"1": (48.8566, 2.3522), "2": (None, None)}


def test_run_pipeline_writes_layers(spark, paths, tmp_path):
    out = str(tmp_path / "out")
    status = {r["table_name"]: r["status"] for r in accident_files.run_pipeline(spark, paths, out).collect()}
    assert set(status) == {"accidents", "places", "vehicles", "persons", "severity",
                           "meteo", "departements", "top_departements_graves"}
    assert set(status.values()) == {"ok"}
    gold = spark.read.parquet(f"{out}/gold/top_departements_graves").orderBy("rang_dep").collect()
    assert [r["dep"] for r in gold] == ["2A", "75", "01"]
    deps = sorted(r["dep"] for r in spark.read.parquet(f"{out}/silver/accidents").select("dep").collect())
    assert deps == ["01", "01", "2A", "75"]   # typed from the data schema, not re-inferred


def test_run_pipeline_bucketed_same_gold(spark, paths, tmp_path):
    out = str(tmp_path / "outb")
    accident_files.run_pipeline(spark, paths, out, buckets=4)
    gold = spark.read.parquet(f"{out}/gold/top_departements_graves").orderBy("rang_dep").collect()
    assert [(r["dep"], r["rang_dep"]) for r in gold] == [("2A", 1), ("75", 2), ("01", 3)]


def test_hour_quality_flags_impossible_hours(spark):
    from strata.operators.clean import hour_quality
    from strata.functions.expressions import hour_from_hrmn
    df = spark.createDataFrame([("06:00",), ("24:10",), ("9:30",), (None,), ("99:99",)], "hrmn string")
    r = hour_quality(df.withColumn("heure_int", hour_from_hrmn("hrmn"))).first()
    assert (r["nb_lignes"], r["heure_absente"], r["heure_mal_formee"], r["heure_hors_journee"]) == (5, 1, 1, 2)


def test_pipeline_metrics_include_bad_cells_and_durations(spark, paths, tmp_path):
    from strata.sources import sinks
    out = str(tmp_path / "outm")
    accident_files.run_pipeline(spark, paths, out)
    m = {(r["step"], r["table_name"], r["metric"]): r["value"]
         for r in sinks.read_metrics_json(spark, f"{out}/logs/metrics").collect()}
    assert m[("typage", "caracteristiques", "cellules_illisibles_an")] == 1      # "abc"
    assert m[("nettoyage", "caracteristiques", "kept_rows")] == 4
    assert ("ecriture_gold", "", "duree_ms") in m


def test_rows_that_differ_in_any_column_stay_apart(spark, tmp_path):
    """Three persons that differ in columns no analysis reads are three persons; two places
    that differ in the street are two; an accident delivered twice with another weather is one."""
    texts = {"caracteristiques": "Num_Acc;jour;mois;an;hrmn;lum;dep;atm\nA;1;1;2020;06:00;1;75;2\nA;1;1;2020;06:00;1;75;1\n",
             "lieux": "Num_Acc;surf;voie\nA;1;rue x\nA;1;rue y\n", "vehicules": "Num_Acc;num_veh;cat_veh\nA;A01;7\n",
             "usagers": "Num_Acc;num_veh;catu;sexe;grav;id_usager;an_nais\nA;A01;2;1;2;1;1990\nA;A01;2;1;2;2;1991\nA;A01;2;1;2;3;1992\n"}
    out = str(tmp_path / "whole")
    accident_files.run_pipeline(spark, _write_delivery(tmp_path, "whole-in", texts), out)
    sev = spark.read.parquet(f"{out}/silver/severity").first()
    assert (sev["nb_usagers"], sev["nb_tues"]) == (3, 3)
    assert {r["voie"] for r in spark.read.parquet(f"{out}/silver/places").collect()} == {"rue x", "rue y"}
    acc = spark.read.parquet(f"{out}/silver/accidents").collect()
    assert [(r["num_acc"], r["atm"]) for r in acc] == [("A", 1)]   # the first by the other columns
    top = spark.read.parquet(f"{out}/gold/top_departements_graves").first()
    assert (top["total_accidents"], top["accidents_graves"], top["taux_graves"]) == (1, 1, 1.0)
    from strata.sources import sinks
    m = {(r["table_name"], r["metric"]): r["value"] for r in sinks.read_metrics_json(spark, f"{out}/logs/metrics").collect()}
    assert m["caracteristiques", "rejected_repeated_key"] == 1 and m["caracteristiques", "kept_rows"] == 1


def test_metrics_of_a_failed_run_tell_the_error(spark, paths, tmp_path):
    from strata.sources import sinks
    out = str(tmp_path / "failed")
    with pytest.raises(FileNotFoundError):
        accident_files.run_pipeline(spark, dict(paths, lieux="/no/such/file.csv"), out)
    rows = sinks.read_metrics_json(spark, f"{out}/logs/metrics").collect()
    assert any(r["step"] == "ingestion" and r["metric"].startswith("erreur: FileNotFoundError") for r in rows)


def test_unreadable_cells_of_every_table_are_counted(spark, tmp_path):
    from strata.sources import sinks
    texts = {"caracteristiques": "Num_Acc;jour;mois;an;hrmn;lum;dep;atm\nA;1;1;2020;06:00;1;75;2\n", "lieux": "Num_Acc;surf\nA;x\nA;x\n",
             "vehicules": "Num_Acc;num_veh;cat_veh\nA;A01;7\n", "usagers": "Num_Acc;num_veh;catu;sexe;grav\nA;A01;2;1;bad\n"}
    out = str(tmp_path / "cells")
    accident_files.run_pipeline(spark, _write_delivery(tmp_path, "cells-in", texts), out)
    m = {(r["table_name"], r["metric"]): r["value"] for r in sinks.read_metrics_json(spark, f"{out}/logs/metrics").collect()}
    assert m["usagers", "cellules_illisibles_grav"] == 1 and m["lieux", "cellules_illisibles_surf"] == 2


def test_empty_folder_is_a_missing_source(spark, tmp_path):
    from strata.sources import files
    (tmp_path / "nothing").mkdir()
    (tmp_path / "some").mkdir()
    (tmp_path / "some" / "a.csv").write_text("x\n1\n")
    assert files.missing_paths(spark, [str(tmp_path / "nothing"), str(tmp_path / "some"), str(tmp_path / "absent")]) == [
        str(tmp_path / "nothing"), str(tmp_path / "absent")]


def test_files_of_a_folder_bind_by_their_own_headers(spark, tmp_path):
    from strata.sources import files
    (tmp_path / "a.csv").write_text("Num_Acc;surf\nA;1\n")
    (tmp_path / "b.csv").write_text("surf;Num_Acc\n2;B\n")
    (tmp_path / "c.csv").write_text("Num_Acc;surf;voie\nC;3;x\n")
    rows = files.read_text_table(spark, str(tmp_path)).select("Num_Acc", "surf", "voie").collect()
    assert sorted(map(tuple, rows), key=str) == [("A", "1", None), ("B", "2", None), ("C", "3", "x")]


def test_older_layout_gold(spark, tmp_path):
    from strata.plans import older_layout
    texts = {"caracteristiques": "Num_Acc;an;jour;heure;dep;agglo;atm;surf;catr;circ;descr_grav\n"
                                 "1;2010;1;06:30;75;1;1;1;1;1;3\n1;2010;1;06:30;75;1;1;1;1;1;3\n2;2010;1;7h;75;1;1;2;1;1;1\n ;2010;1;06:30;75;1;1;1;1;1;3\n3;1990;1;06:30;75;1;1;1;1;1;3\n",
             "lieux": "Num_Acc;com;dep;lat;long;catv\n1;x; 75 ;48,1;2,1;1\n1;y;75;48,2;2,1;1\n2;x;69;;;1\n2;x;;;;1\n",
             "vehicules": "Num_Acc;num_veh;cat_veh;obs;obsm;choc;manv\n1;A;1;;;;\n", "usagers": "Num_Acc;num_veh;catu;sexe;trajet;locp\n1;A;1;1;;\n"}
    tables = older_layout.silver(older_layout.ingest(spark, _write_delivery(tmp_path, "older", texts)))
    gold = older_layout.gold(tables)
    assert [tuple(r) for r in gold["gravite_par_meteo"].collect()] == [("1", "1", 1, 1), ("1", "2", 1, 0)]
    assert [tuple(r) for r in gold["accidents_par_dep_heure"].collect()] == [("69", None, 1), ("75", 6, 1)]
    assert [(r["dep"], r["taux_graves"], r["rang_dep"]) for r in gold["top_departements_gravite"].collect()] == [("75", 1.0, 1), ("69", 0.0, 2)]
    assert tables["usagers"].count() == tables["vehicules"].count() == 1 and tables["lieux"].count() == 3


def test_outlier_reasons(spark):
    from strata.operators.clean import CleanRules, clean, clean_report, with_reject_reason
    rules = CleanRules(key="k", nonnegative=("v",), dates=(("y", "m", "d"),))
    df = spark.createDataFrame([("1", "5", "2020", "2", "29"), ("2", "-1", "2020", "1", "1"), ("3", "x", "2021", "2", "29"), ("4", None, "n/a", "2", "31")], "k string, v string, y string, m string, d string")
    got = {r["k"]: r["reject_reason"] for r in with_reject_reason(df, rules).collect()}
    assert got == {"1": None, "2": "negative_v", "3": "impossible_date_y_m_d", "4": None}
    assert sorted(r["k"] for r in clean(df, rules).collect()) == ["1", "4"]
    r = clean_report(df, rules, "t").first()
    assert (r["raw_rows"], r["rejected_outlier"], r["kept_rows"]) == (4, 2, 2)


def test_crosstab_counts_every_row(spark):
    df = spark.createDataFrame([("a", 1), ("a", 9), ("a", None), ("b", 2)], "dep string, meteo int")
    rows = agg.crosstab(df, "dep", "meteo", [1, 2], "m_").orderBy("dep").collect()
    assert [tuple(r) for r in rows] == [("a", 1, 0, 2), ("b", 0, 1, 0)]


def test_pipeline_cli(paths, tmp_path):
    import subprocess
    import sys
    out = tmp_path / "cli"
    repo = __import__("os").path.dirname(__import__("os").path.dirname(__file__))
    r = subprocess.run(
        [sys.executable, "-m", "strata.plans.accident_files", "--master", "local[2]",
         "--caracteristiques", paths["caracteristiques"], "--lieux", paths["lieux"],
         "--vehicules", paths["vehicules"], "--usagers", paths["usagers"], "--out", str(out)],
        cwd=repo, capture_output=True, text=True, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]
    assert "top_departements_graves" in r.stdout and "failed" not in r.stdout
    assert (out / "gold" / "meteo").exists()


# a second delivery: accident 02 re-delivered with changed persons (no longer
# serious) and weather; a new accident 08 in department 75
CARAC2 = """Num_Acc;jour;mois;an;hrmn;lum;dep;atm;adr
202300000002;07;05;2023;19:30;7;2A;3;x
202300000008;02;02;2024;08:15;1;75;1;y
"""
LIEUX2 = "Num_Acc;surf\n202300000008;3\n"
VEHICULES2 = "Num_Acc;num_veh;cat_veh\n202300000008;A01;7\n"
USAGERS2 = """Num_Acc;num_veh;catu;sexe;grav
202300000002;A01;1;1;4
202300000008;A01;1;1;2
"""


def _write_delivery(tmp_path, name, texts):
    d = tmp_path / name
    d.mkdir()
    out = {}
    for table, text in texts.items():
        p = d / f"{table}.csv"
        p.write_bytes(text.encode("iso-8859-1"))
        out[table] = str(p)
    return out


def test_incremental_silver_upsert(spark, paths, tmp_path):
    out = str(tmp_path / "incr")
    accident_files.run_pipeline(spark, paths, out, mode="upsert")
    second = _write_delivery(tmp_path, "d2", {"caracteristiques": CARAC2, "lieux": LIEUX2,
                                              "vehicules": VEHICULES2, "usagers": USAGERS2})
    accident_files.run_pipeline(spark, second, out, mode="upsert")
    acc = {short(r["num_acc"]): r["meteo"] for r in
           spark.read.parquet(f"{out}/silver_incremental/accidents").collect()}
    assert acc == {"01": 2, "02": 3, "05": 1, "06": 1, "08": 1}
    sev = {short(r["num_acc"]): (r["gravite_max"], r["nb_usagers"], r["accident_grave"]) for r in
           spark.read.parquet(f"{out}/silver_incremental/severity").collect()}
    assert sev["02"] == (2, 1, 0)          # replaced: one lightly injured person
    assert sev["01"] == (4, 2, 1)          # untouched
    assert sev["08"] == (4, 1, 1)
    places = sorted((short(r["num_acc"]), r["surf"]) for r in
                    spark.read.parquet(f"{out}/silver_incremental/places").collect())
    assert places == [("01", 1), ("01", 2), ("02", 2), ("05", 1), ("06", 1), ("08", 3)]
    gold = {r["dep"]: (r["total_accidents"], r["accidents_graves"]) for r in
            spark.read.parquet(f"{out}/gold/top_departements_graves").collect()}
    assert gold == {"2A": (1, 0), "75": (2, 2), "01": (2, 0)}
    # the same delivery again changes nothing
    before = sorted(spark.read.parquet(f"{out}/silver_incremental/persons").collect())
    accident_files.run_pipeline(spark, second, out, mode="upsert")
    assert sorted(spark.read.parquet(f"{out}/silver_incremental/persons").collect()) == before
