"""Wide station tables of several files."""

import pytest

from airstrata.plans.tables import clean_wide_table
from airstrata.sources.wide import file_columns, read_wide_long, read_wide_table


def land(tmp_path, **files):
    folder = tmp_path / "wide"
    for name, (names, rows) in files.items():
        file = folder / f"{name.replace('_', '/')}.csv"
        file.parent.mkdir(parents=True, exist_ok=True)
        top = [["h", *[f"c{i}" for i, _ in enumerate(names)]], ["n", *names], ["name", *names]]
        top += [["low", *["0"] * len(names)], ["high", *["9"] * len(names)], ["unit", *["µg"] * len(names)]]
        file.write_text("\n".join(",".join(map(str, r)) for r in [*(top if names else []), *rows]) + "\n")
    return str(folder)


def as_dicts(df):
    return sorted((r.asDict() for r in df.collect()), key=repr)


T1, T2, T3 = (f"2025-03-01 0{h}:00:00" for h in (1, 2, 3))


def test_files_in_other_orders(spark, tmp_path):
    path = land(tmp_path, a=(["S1", "S2"], [[T1, 1, 2]]), b=(["S2", "S1"], [[T2, 1, 2]]))
    df = read_wide_table(spark, path)
    assert df.columns == ["time", "S1", "S2"]
    assert as_dicts(df) == [{"time": T1, "S1": 1.0, "S2": 2.0}, {"time": T2, "S1": 2.0, "S2": 1.0}]


def test_files_with_other_stations(spark, tmp_path):
    path = land(tmp_path, a=(["S1", "S2"], [[T1, 1, 2]]), b=(["S3", "S1"], [[T2, 3, "x"]]), c=(["S2"], [[T3, 5]]))
    assert as_dicts(read_wide_table(spark, path)) == [
        {"time": T1, "S1": 1.0, "S2": 2.0, "S3": None},
        {"time": T2, "S1": None, "S2": None, "S3": 3.0},
        {"time": T3, "S1": None, "S2": 5.0, "S3": None},
    ]
    found = sorted(map(tuple, read_wide_long(spark, path).collect()))
    assert [r for r in found if r[2] is not None] == [(T1, "S1", 1.0), (T1, "S2", 2.0), (T2, "S3", 3.0), (T3, "S2", 5.0)]
    assert (T2, "S1", None) in found and len(found) == 5
    complete = sorted(map(tuple, read_wide_long(spark, path, complete=True).collect()))
    assert complete == [(T1, "S1", 1.0), (T1, "S2", 2.0), (T3, "S2", 5.0)]


def test_a_file_without_header_goes_on_with_the_one_before(spark, tmp_path):
    path = land(
        tmp_path, a_1=(["S1", "S2"], [[T1, 1, 2]]), a_2=([], [[T2, 3, 4], ["?", 9, 9]]),
        b_1=(["S2", "S1"], [[T1, 5, 6]]), b_2=([], [["?", 9, 9], [T3, 7, 8]]),
    )
    assert as_dicts(read_wide_table(spark, f"{path}/*")) == [
        {"time": T1, "S1": 1.0, "S2": 2.0}, {"time": T1, "S1": 6.0, "S2": 5.0},
        {"time": T2, "S1": 3.0, "S2": 4.0}, {"time": T3, "S1": 8.0, "S2": 7.0},
    ]


def test_no_names_at_all(spark, tmp_path):
    path = land(tmp_path, a=([], [[T1, 1, 2]]), b=(["S1"], [[T2, 3]]))
    with pytest.raises(Exception, match="no row of names"):
        read_wide_table(spark, path).collect()


def test_names_in_quotes(spark, tmp_path):
    path = land(tmp_path, a=(['"Pau, ""Est"""', "x.y"], [[T1, 1, 2]]), b=(["x.y", '"Pau, ""Est"""'], [[T2, 1, 2]]))
    names = {r.file.rsplit("/", 1)[1]: r.names for r in file_columns(spark, path).collect()}
    assert names == {"a.csv": ["time", 'Pau, "Est"', "x.y"], "b.csv": ["time", "x.y", 'Pau, "Est"']}
    assert as_dicts(read_wide_table(spark, path)) == [
        {"time": T1, 'Pau, "Est"': 1.0, "x.y": 2.0}, {"time": T2, 'Pau, "Est"': 2.0, "x.y": 1.0},
    ]


def test_cleaning_of_several_files(spark, tmp_path):
    path = land(
        tmp_path, a=(["S1", "S2"], [[T1, 1, 2], [T2, -1, 2]]), b=(["S2", "S1"], [[T2, 3, "NaN"], [T3, 4, 0]]),
    )
    assert as_dicts(clean_wide_table(spark, path)) == [
        {"time": T1, "S1": 1.0, "S2": 2.0}, {"time": T3, "S1": 0.0, "S2": 4.0},
    ]


def test_files_that_agree_are_one_scan(spark, tmp_path):
    path = land(tmp_path, a=(["S1", "S2"], [[T1, 1, 2]]), b=(["S1", "S2"], [[T2, 3, 4]]))
    plan = read_wide_table(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("FileScan") == 1
