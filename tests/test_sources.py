import glob
import os

from pyspark.sql import functions as F

from quarry.session import scratch_path
from quarry.sources import csv as csvio
from quarry.sources import text as textio

LINES = [
    'a,b,c',
    'id1,"x, y",z',
    'id2,"say ""hi"", ok",last',
    'id3,,"",end',
    'solo',
]
EXPECTED = [
    ["a", "b", "c"],
    ["id1", '"x, y"', "z"],
    ["id2", '"say ""hi"", ok"', "last"],
    ["id3", "", '""', "end"],
    ["solo"],
]


def test_split_quoted(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "line string")
    got = [list(r[0]) for r in df.select(textio.split_quoted("line")).collect()]
    assert got == EXPECTED


def _split_brute(line):
    fields, start = [], 0
    for i, c in enumerate(line):
        if c == "," and line[i:].count('"') % 2 == 0:
            fields.append(line[start:i])
            start = i + 1
    return [*fields, line[start:]]


def test_split_quoted_on_stray_quotes(spark):
    import random
    rng = random.Random(1)
    lines = ['a,5" disc,x', 'id,say "hi,b,c', '"', '",', ',"', '', ',', 'x"y,z"', '"a","b,c']
    lines += ["".join(rng.choice('a",b') for _ in range(rng.randrange(12))) for _ in range(400)]
    df = spark.createDataFrame([(x,) for x in [*lines, None]], "line string")
    got = [r[0] and list(r[0]) for r in df.select(textio.split_quoted("line")).collect()]
    assert got == [*map(_split_brute, lines), None]


def test_short_lines_give_null_fields(spark):
    df = spark.createDataFrame([("a,b",)], "value string")
    row = df.select(*textio.observations_from_fields(textio.split_quoted("value"))).first()
    assert row.item_id == "a" and row.obs_date == "b" and row.market is None and row.views is None


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _write_obs_csv(spark, path):
    header = ",".join(f"h{i}" for i in range(18))
    rows = [
        ["v1", "17.14.11", "t", "x", "x", "Music", "x", "x", "100"] + ["x"] * 8 + ["US"],
        ["v2", "17.14.11", '"a, b"', "x", "x", "Music", "x", "x", "7"] + ["x"] * 8 + ["GB"],
    ]
    os.makedirs(_local(path), exist_ok=True)
    with open(os.path.join(_local(path), "part-0.csv"), "w") as f:
        f.write(header + "\n" + "\n".join(",".join(r) for r in rows) + "\n")


def test_read_observations_csv_and_lines(spark):
    path = scratch_path(spark, "test-obs")
    _write_obs_csv(spark, path)
    obs = textio.read_observations(spark, path).orderBy("item_id").collect()
    assert [(r.item_id, r.category, r.views, r.market) for r in obs] == [
        ("v1", "Music", 100, "US"), ("v2", "Music", 7, "GB")]
    raw = textio.read_observation_lines(spark, path).collect()
    assert len(raw) == 3  # the header line is data in the raw form
    assert {r.market for r in raw} == {"h17", "US", "GB"}


def test_keyed_text_three_files_sorted(spark):
    df = spark.range(60).select((F.col("id") % 12).cast("string").alias("k"), F.col("id").alias("v"))
    path = scratch_path(spark, "test-keyed")
    textio.write_keyed_text(df, "k", "v", path, 3)
    parts = sorted(glob.glob(os.path.join(_local(path), "part-*")))
    assert 1 <= len(parts) <= 3
    for p in parts:
        keys = [line.split("\t")[0] for line in open(p).read().splitlines()]
        assert keys == sorted(keys)
    back = textio.read_keyed_text(spark, path, "k", "v")
    assert back.count() == 60 and back.select("k").distinct().count() == 12


def test_sorted_text_is_globally_ordered(spark):
    df = spark.range(1000).select(F.format_string("%05d", (F.col("id") * 7919) % 1000).alias("line"))
    path = scratch_path(spark, "test-sorted")
    textio.write_sorted_text(df.repartition(5), [F.col("line").desc()], "line", path)
    parts = sorted(glob.glob(os.path.join(_local(path), "part-*")))
    lines = [x for p in parts for x in open(p).read().splitlines()]
    assert lines == sorted(lines, reverse=True) and len(lines) == 1000


def test_labelled_csv_roundtrip_label_first_and_last(spark):
    df = spark.createDataFrame([(1, [0.5, 2.0, -1.0]), (0, [3.0, 0.0, 1.25])], "label int, f array<double>")
    for first in (True, False):
        path = scratch_path(spark, "test-labelled")
        csvio.write_labelled_csv(df, "label", "f", path, label_first=first)
        back = csvio.read_labelled_csv(spark, path, n_features=3, label_first=first)
        got = sorted((r.label, list(r.features)) for r in back.collect())
        assert got == [(0, [3.0, 0.0, 1.25]), (1, [0.5, 2.0, -1.0])]
        inferred = csvio.read_labelled_csv(spark, path, label_first=first)
        assert inferred.count() == 2


def test_confusion_csv_roundtrip(spark):
    from quarry.operators import evaluation as ev
    pred = spark.createDataFrame([(0, 0), (1, 1), (1, 0), (2, 2), (2, 2)], "actual int, predicted int")
    m = ev.confusion_matrix(pred, 3)
    path = scratch_path(spark, "test-confusion")
    csvio.write_confusion_csv(ev.confusion_wide(m, 3), path)
    back = csvio.read_confusion_csv(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, m.collect()))


def test_confusion_csv_keeps_labels_outside_the_grid(spark):
    from quarry.operators import evaluation as ev
    pred = spark.createDataFrame([(0, -1), (1, 1), (12, 0), (None, 2), (2, None), (2, 2)], "actual int, predicted int")
    m = ev.confusion_matrix(pred, 3)
    wide = ev.confusion_wide(m, 3)
    assert wide.columns == ["predicted", "actual_-1", "actual_0", "actual_1", "actual_2", "actual_12", "actual_null"]
    path = scratch_path(spark, "test-confusion")
    csvio.write_confusion_csv(wide, path)
    several = scratch_path(spark, "test-confusion")
    wide.repartition(3).write.option("header", True).csv(several)
    for p in (path, several):
        got = {(r.predicted, r.actual): r.n for r in csvio.read_confusion_csv(spark, p).collect() if r.n}
        assert got == {(-1, 0): 1, (1, 1): 1, (0, 12): 1, (2, None): 1, (None, 2): 1, (2, 2): 1}


def test_plain_matrix_needs_one_file_of_n_rows(spark):
    import pytest
    path = scratch_path(spark, "test-plain")
    os.makedirs(_local(path), exist_ok=True)
    with open(os.path.join(_local(path), "part-0.csv"), "w") as f:
        f.write("1.0,2\n3,4.0\n")
    got = {(r.predicted, r.actual): r.n for r in csvio.read_plain_confusion_csv(spark, path, 2).collect()}
    assert got == {(0, 0): 1, (0, 1): 2, (1, 0): 3, (1, 1): 4}
    with pytest.raises(ValueError):
        csvio.read_plain_confusion_csv(spark, path, 3)
    with open(os.path.join(_local(path), "part-1.csv"), "w") as f:
        f.write("5,6\n")
    with pytest.raises(ValueError):
        csvio.read_plain_confusion_csv(spark, path, 2)


def test_wide_samples_ragged_arrays_and_bad_cells(spark):
    import pytest
    for width in (1024, 3072):
        path = scratch_path(spark, "test-wide")
        os.makedirs(_local(path), exist_ok=True)
        with open(os.path.join(_local(path), "part-0.csv"), "w") as f:
            f.write("".join(f"{i}," + ",".join(str(i + j) for j in range(width)) + "\n" for i in range(3)))
        rows = sorted(csvio.read_labelled_csv(spark, path).collect(), key=lambda r: r.label)
        assert [(r.label, len(r.features), r.features[width - 1]) for r in rows] == [(i, width, i + width - 1.0) for i in range(3)]
    ragged = spark.createDataFrame([(1, [0.5, 2.0]), (0, [3.0]), (2, None)], "label int, f array<double>")
    path = scratch_path(spark, "test-ragged")
    csvio.write_labelled_csv(ragged, "label", "f", path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["0,3.0,", "1,0.5,2.0", "2,,"]
    with pytest.raises(Exception, match="missing or non-numeric feature in .*test-ragged"):
        csvio.read_labelled_csv(spark, path, n_features=2).collect()


def test_intermediate_folder_is_refused_off_a_local_master():
    import pytest
    from types import SimpleNamespace

    from quarry import session

    def spark(master, conf):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=lambda: conf, setCheckpointDir=lambda d: None)
        return SimpleNamespace(sparkContext=sc)

    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.checkpoint_dir(spark(master, {}))
    assert session.checkpoint_dir(spark("yarn", {"spark.checkpoint.dir": "hdfs:///x"})) == "hdfs:///x"


def test_keyed_text_keeps_tabs_inside_values(spark):
    df = spark.createDataFrame([("k1", "a\tb"), ("k2", "plain")], "k string, v string")
    path = scratch_path(spark, "test-keyed-tabs")
    textio.write_keyed_text(df, "k", "v", path, 2)
    got = sorted(map(tuple, textio.read_keyed_text(spark, path, "k", "v").collect()))
    assert got == [("k1", "a\tb"), ("k2", "plain")]


def test_read_observations_permissive_on_short_and_long_rows(spark):
    path = scratch_path(spark, "test-obs-ragged")
    os.makedirs(_local(path), exist_ok=True)
    header = ",".join(f"h{i}" for i in range(18))
    short = "v1,17.14.11,x,x,x,Music"
    long_ = ",".join(["v2", "17.14.11"] + ["x"] * 3 + ["Film"] + ["x"] * 2 + ["9"] + ["x"] * 8 + ["US", "extra"])
    with open(os.path.join(_local(path), "part-0.csv"), "w") as f:
        f.write("\n".join([header, short, long_]) + "\n")
    rows = {r.item_id: r for r in textio.read_observations(spark, path).collect()}
    assert rows["v1"].category == "Music" and rows["v1"].market is None and rows["v1"].views is None
    assert rows["v2"].category == "Film" and rows["v2"].market == "US" and rows["v2"].views == 9
