import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from lacuna.sources import commits
from lacuna.sources import state as st


def test_a_file_is_created_by_one_writer_only(spark, tmp_path):
    path = str(tmp_path / "sub" / "value")
    with ThreadPoolExecutor(16) as pool:
        won = list(pool.map(lambda i: commits.create_once(spark, path, f"text {i}"), range(64)))
    assert won.count(True) == 1
    assert commits.read_text(spark, path) == f"text {won.index(True)}"
    assert os.listdir(tmp_path / "sub") == ["value"]
    assert commits.read_text(spark, str(tmp_path / "none")) is None
    assert commits.names(spark, str(tmp_path / "none")) == []


def test_the_rename_of_other_file_systems(spark, tmp_path):
    """``viewfs`` stands for a cluster's store: no links, the name is taken by a rename that fails if it is there."""
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.lab.link./data", tmp_path.as_uri())
    path = "viewfs://lab/data/value"
    assert commits.create_once(spark, path, "a") and not commits.create_once(spark, path, "b")
    assert commits.read_text(spark, path) == "a"


def test_published_once_under_racing_writers(spark, tmp_path):
    path = str(tmp_path / "scale")

    def publish(i):
        return commits.publish_once(spark.range(1).select(F.lit(float(i)).alias("scale")), path).first()[0]

    with ThreadPoolExecutor(4) as pool:
        seen = set(pool.map(publish, range(4)))
    assert len(seen) == 1 and commits.published(spark, path).first()[0] in seen
    with pytest.raises(FileNotFoundError):
        commits.published(spark, str(tmp_path / "other"))


def rows(spark, slices, iterations, value=0.0):
    return spark.createDataFrame([(1, s, iterations, [value], [0.0]) for s in slices], st.STATE_DDL)


def state(spark, path):
    return {r.slice: (r.iterations, r.re[0]) for r in st.read_state(spark, path).collect()}


def test_concurrent_attempts_all_count(spark, tmp_path):
    path = str(tmp_path / "state")
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: st.append_attempt(rows(spark, [i, 100], i), path, i, most=3), range(1, 13)))
    assert state(spark, path) == {**{i: (i, 0.0) for i in range(1, 13)}, 100: (12, 0.0)}
    assert st.last_attempt(spark, path) == 12


def test_reads_touch_few_folders_however_many_attempts(spark, tmp_path):
    path, want = str(tmp_path / "state"), {}
    for i in range(1, 41):
        slices = range(200) if i == 1 else [i % 7, i]
        st.append_attempt(rows(spark, slices, i, i / 2), path, i, most=4)
        want |= {s: (i, i / 2) for s in slices}
        log = st.state_log(spark, path)
        assert len(log.snapshot().parts) <= 4
        # the large first attempt is not written again with every fold
        assert any(p.rows >= 200 for p in log.snapshot().parts)
    assert state(spark, path) == want
    written = [commits.json.loads(commits.read_text(spark, f"{path}/_log/{n}")) for n in commits.names(spark, f"{path}/_log")]
    assert sum(p[2] for p in {tuple(map(str, p[:1])) + tuple(p[:3]): p for parts in written for p in parts}.values()) < 200 * 8
    before = len(commits.names(spark, path))
    assert log.purge() > 0 and len(commits.names(spark, path)) < before
    assert state(spark, path) == want


def test_a_repeated_attempt_replaces_itself_until_folded(spark, tmp_path):
    path = str(tmp_path / "state")
    st.append_attempt(rows(spark, [1, 2], 5), path, 1)
    st.append_attempt(rows(spark, [1], 7), path, 2)
    st.append_attempt(rows(spark, [1, 3], 8), path, 2)
    st.append_attempt(rows(spark, [2], 4), path, 1)  # late, and without slice 1
    assert state(spark, path) == {1: (8, 0.0), 2: (4, 0.0), 3: (8, 0.0)}
    log = st.state_log(spark, path, most=1)
    log.compact()
    assert len(log.snapshot().parts) == 1 and state(spark, path) == {1: (8, 0.0), 2: (4, 0.0), 3: (8, 0.0)}
    with pytest.raises(ValueError, match="folded"):
        log.append(rows(spark, [1], 1), 2)


def test_a_fold_that_lost_the_race_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "state")
    log = st.state_log(spark, path, most=1)
    log.append(rows(spark, [1], 1), 1)
    log.append(rows(spark, [1], 2), 2)
    write = log._write

    def slow(*args):
        part = write(*args)
        log._write = write
        log.append(rows(spark, [1], 9), 2)  # attempt 2 again while it is being folded
        return part

    log._write = slow
    log.compact()
    assert state(spark, path) == {1: (9, 0.0)}


def test_no_attempt_yet(spark, tmp_path):
    path = str(tmp_path / "state")
    assert st.last_attempt(spark, path) is None
    assert st.read_state(spark, path).collect() == [] and st.header(spark, path).collect() == []


def test_runs_of_attempts():
    assert commits._joined([(5, 5), (1, 2), (3, 3), (8, 9), (6, 6)]) == ((1, 3), (5, 6), (8, 9))
