import random
from pathlib import Path

import pytest
from pyarrow import fs

from tapeflow.sources import growing as W
from tapeflow.streaming import ingest as I

NOW = {"availableNow": True}


class Tail:
    """A query that is started, reads what there is, and ends."""

    def __init__(self, spark, folder, split=W.SPLIT_BYTES):
        self.spark, self.split = spark, split
        self.logs, self.out, self.checkpoint = folder / "logs", str(folder / "out"), str(folder / "checkpoint")

    def run(self):
        lines = W.growing_log_stream(self.spark, f"{self.logs}/*/*log", self.split)
        I.start_closed(lines, self.out, self.checkpoint, NOW).awaitTermination()
        got = self.spark.read.schema("value binary, path string").parquet(self.out).collect()
        return sorted((Path(r.path).name, bytes(r.value)) for r in got)

    def append(self, name, data):
        path = self.logs / "c" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        with open(path, "ab") as file:
            file.write(data)


def test_appended_lines_once_and_half_lines_wait(spark, tmp_path):
    tail = Tail(spark, tmp_path)
    tail.append("a.log", b"one\ntwo\nthr")
    tail.append("b.log", b"half")
    tail.append("other.txt", b"no\n")
    tail.append(".hidden.log", b"no\n")
    assert tail.run() == [("a.log", b"one"), ("a.log", b"two")]
    assert len(tail.run()) == 2  # nothing new
    tail.append("a.log", b"ee\r\n\n\xff\xfe\n")
    tail.append("c.log", b"new\n")
    expected = [("a.log", v) for v in (b"one", b"two", b"three", b"", b"\xff\xfe")] + [("c.log", b"new")]
    assert tail.run() == sorted(expected)
    tail.append("b.log", b" line\nand")
    (tail.logs / "c" / "a.log").write_bytes(b"again\n")  # shorter: another file
    assert tail.run() == sorted([*expected, ("b.log", b"half line"), ("a.log", b"again")])


def test_large_files_in_ranges(spark, tmp_path):
    rng, tail = random.Random(3), Tail(spark, tmp_path, split=1000)
    lines = [bytes(rng.choice(b"abc") for _ in range(rng.choice([0, 1, 7, 300, 2500]))) for _ in range(200)]
    tail.append("a.log", b"\n".join(lines[:90]) + b"\n")
    tail.run()
    tail.append("a.log", b"\n".join(lines[90:]) + b"\n")
    assert tail.run() == sorted(("a.log", line) for line in lines)


@pytest.mark.parametrize("piece", [1, 3, 64])
def test_every_cut_gives_each_line_once(tmp_path, monkeypatch, piece):
    monkeypatch.setattr(W, "_PIECE", piece)
    data = b"skipped\n" + b"\n\na\nbb\n\nccc\n" + b"d" * 20 + b"\ne\n"
    path = tmp_path / "x"
    path.write_bytes(data)
    files = fs.LocalFileSystem()
    for size in range(1, len(data) + 1):
        got = []
        for low in range(8, len(data), size):
            for lines in W.lines_of(files, W.Range(str(path), 8, low, min(low + size, len(data)))):
                got += lines
        assert got == data[8:].split(b"\n")[:-1], size


def test_last_line_end(tmp_path):
    path, files = tmp_path / "x", fs.LocalFileSystem()
    for data, known, end in ((b"", 0, 0), (b"abc", 0, 0), (b"a\nbc", 0, 2), (b"a\nbc", 2, 2), (b"a\n" + b"b" * 200_000, 0, 2)):
        path.write_bytes(data)
        assert W.last_line_end(files, str(path), len(data), known) == end
