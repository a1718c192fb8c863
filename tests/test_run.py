"""Block file to 16-bit images, and the same run resumed with more iterations."""

import numpy as np
from blockfile import block_file

from lacuna.functions import kernels, linops
from lacuna.operators import recovery as rc
from lacuna.plans import run

rng = np.random.default_rng(4)
NX, N = 6, 16


def acquisition(path):
    volumes = np.zeros((2, NX, N, N))
    for v in range(2):
        for x in range(NX):
            y, z = rng.integers(3, 9, 2)
            volumes[v, x, y:y + 4, z:z + 4] = 100 / (1 + v)
    k = kernels.fft2_centred(volumes)
    r = np.hypot(*np.mgrid[-N // 2:N // 2, -N // 2:N // 2]) / N
    p = np.clip(np.exp(-(4 * r) ** 2) + 0.45, 0, 1)
    positions = np.flatnonzero((rng.random((N, N)) < p).T.ravel())
    flat = np.swapaxes(k, 2, 3).reshape(2, NX, -1)[:, :, positions]
    traces = kernels.readout_fft(np.swapaxes(flat, 1, 2))  # (volume, trace, point)
    block_file(path, traces)
    return volumes, positions, p.T.ravel()


def test_run_end_to_end_and_resume(spark, tmp_path):
    volumes, positions, density = acquisition(tmp_path / "run.fid")
    masks = spark.createDataFrame([(0, [int(i) for i in positions], [float(v) for v in density])],
                                  "mask_id int, positions array<int>, density array<double>")
    opts = lambda n: rc.RecoveryOptions(N, N, passes=((n, 0.002, 0.002),), window=8, transform=linops.Wavelet("Haar", 0, 2))
    out = str(tmp_path / "out")

    def images(n):
        rows = run.recover_run(spark, str(tmp_path / "run.fid"), masks, opts(n), out, len(positions), slices=12).collect()
        assert len(rows) == 2 * NX
        got = np.zeros(volumes.shape)
        for r in rows:
            got[r["volume"] - 1, r["slice"]] = np.array(r["value"]).reshape(N, N).T
        return got

    def errors(got):
        unit = got / got[0].max() * volumes[0].max()
        return [np.linalg.norm(unit[v] - volumes[v].clip(max=volumes[0].max())) / np.linalg.norm(volumes[0]) for v in range(1)]

    first, second = images(5), images(60)
    assert first.max() == 65535 and second[0].max() >= 60000
    assert errors(second)[0] < errors(first)[0] and errors(second)[0] < 0.25
    assert 0.4 < second[1].mean() / second[0].mean() < 0.7  # one study scale for all volumes
    state = run.st.read_attempts(spark, out + "/state").groupBy("attempt").count().collect()
    assert sorted(r["attempt"] for r in state) == [1, 2]


def test_files_and_echoes_stay_apart(spark, tmp_path):
    """Two files with equal block numbers, two echoes, one cut file and one block without data."""
    folder = tmp_path / "files"
    folder.mkdir()
    for name in ("a.fid", "b.fid", "cut.fid"):
        block_file(folder / name, rng.normal(size=(2, 8, 4)) + 1j * rng.normal(size=(2, 8, 4)), ready=[True, name != "b.fid"])
    cut = (folder / "cut.fid").read_bytes()
    (folder / "cut.fid").write_bytes(cut[:-10])
    run.register(spark)
    bad = {(r.path.rsplit("/", 1)[1], r.block): r.reason for r in run.quarantine(spark, str(folder)).collect()}
    assert bad == {("b.fid", 2): "no data", ("cut.fid", 2): "short"}
    first = run.number_volumes(spark, str(folder / "b.fid"), 2, str(tmp_path / "v")).collect()
    assert sorted((r.block, r.echo, r.volume) for r in first) == [(1, 0, 1), (1, 1, 2)]
    both = run.number_volumes(spark, str(folder), 2, str(tmp_path / "v")).collect()
    assert sorted(r.volume for r in both) == list(range(1, len(both) + 1))
    assert {(r.block, r.echo): r.volume for r in both if r.path.endswith("b.fid")} == {(1, 0): 1, (1, 1): 2}
    assert len({(r.path, r.block, r.echo) for r in both}) == len(both)


def test_two_files_are_two_volumes_each(spark, tmp_path):
    folder = tmp_path / "two"
    folder.mkdir()
    _, positions, density = acquisition(folder / "a.fid")
    (folder / "b.fid").write_bytes((folder / "a.fid").read_bytes())
    masks = spark.createDataFrame([(0, [int(i) for i in positions], [float(v) for v in density])],
                                  "mask_id int, positions array<int>, density array<double>")
    opts = rc.RecoveryOptions(N, N, passes=((3, 0.002, 0.002),), window=8, transform=linops.Wavelet("Haar", 0, 2))
    out = str(tmp_path / "out")
    rows = run.recover_run(spark, str(folder), masks, opts, out, len(positions)).collect()
    got = {(r["volume"], r["slice"]): r["value"] for r in rows}
    assert len(got) == 4 * NX and all(got[1, x] == got[3, x] and got[2, x] == got[4, x] for x in range(NX))
    assert spark.read.parquet(out + "/quarantine").count() == 0


def test_echoes_come_from_the_header(spark, tmp_path):
    """A single block of interleaved volumes is recovered as if its echoes were named, beside a file of two blocks."""
    folder = tmp_path / "mixed"
    folder.mkdir()
    _, positions, density = acquisition(folder / "blocks.fid")
    data = (folder / "blocks.fid").read_bytes()
    size = (len(data) - 32) // 2
    traces = [np.frombuffer(data[32 + k * size + 28:32 + (k + 1) * size], dtype=np.uint8).reshape(len(positions), -1) for k in range(2)]
    blank = np.zeros((1, 2 * len(positions), NX), dtype=complex)
    block_file(folder / "single.fid", blank)
    made = bytearray((folder / "single.fid").read_bytes())
    made[60:] = np.stack(traces, axis=1).tobytes()  # trace numbers run echo by echo
    (folder / "single.fid").write_bytes(bytes(made))
    counts = {r.path.rsplit("/", 1)[1]: r.echoes for r in run.echo_counts(spark, str(folder), len(positions)).collect()}
    assert counts == {"blocks.fid": 1, "single.fid": 2}
    masks = spark.createDataFrame([(0, [int(i) for i in positions], [float(v) for v in density])],
                                  "mask_id int, positions array<int>, density array<double>")
    opts = rc.RecoveryOptions(N, N, passes=((3, 0.002, 0.002),), window=8, transform=linops.Wavelet("Haar", 0, 2))
    rows = run.recover_run(spark, str(folder), masks, opts, str(tmp_path / "out"), len(positions)).collect()
    got = {(r["volume"], r["slice"]): r["value"] for r in rows}
    assert len(got) == 4 * NX and all(got[1, x] == got[3, x] and got[2, x] == got[4, x] for x in range(NX))
