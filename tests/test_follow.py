"""Following files that grow, rotate and are cut short: every complete line arrives exactly once."""

import os
from collections import Counter

import pytest

from logweft.sources import follow


class Followed:
    """A stream into a Parquet table, run batch by batch, each time by a new query."""

    def __init__(self, spark, folder, **options):
        self.spark, self.folder, self.options = spark, folder, options
        (folder / "logs").mkdir()

    def path(self, name):
        return self.folder / "logs" / name

    def append(self, name, text):
        with open(self.path(name), "ab") as file:
            file.write(text.encode())

    def run(self):
        lines = follow.follow_log_lines(self.spark, str(self.folder / "logs"), **self.options)
        query = lines.writeStream.format("parquet").option("checkpointLocation", str(self.folder / "state")).trigger(
            processingTime="0 seconds").start(str(self.folder / "out"))
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    def rows(self):
        return self.spark.read.parquet(str(self.folder / "out")).collect()

    def values(self):
        return Counter(r.value for r in self.rows())


@pytest.fixture
def followed(spark, tmp_path):
    return Followed(spark, tmp_path)


def lines_of(tag, n, width=20):
    return [f"{tag} {k} " + "x" * (k % width) for k in range(n)]


def test_growing_rotated_and_cut_files(followed):
    want = Counter()

    def write(name, lines, end="\n"):
        followed.append(name, "\n".join(lines) + end)
        want.update(lines)

    write("app.log", lines_of("first", 50))
    write("other.log", lines_of("é中", 5), end="")  # the last line is not complete
    want.subtract(["é中 4 xxxx"])
    followed.run()
    assert followed.values() == +want

    followed.append("other.log", " now whole\n")  # completed
    want.update(["é中 4 xxxx now whole"])
    write("app.log", lines_of("second", 30))
    followed.run()
    assert followed.values() == +want

    write("app.log", lines_of("before rotation", 7))  # not yet read when the file is renamed
    os.rename(followed.path("app.log"), followed.path("app.log.20240101_000000.1"))
    write("app.log", lines_of("after rotation", 200))
    followed.run()
    assert followed.values() == +want

    with open(followed.path("other.log"), "wb"):
        pass  # cut short
    write("other.log", ["new start"])
    followed.run()
    assert followed.values() == +want
    followed.run()  # nothing new
    assert followed.values() == +want
    rows = followed.rows()
    assert {r.source for r in rows} == {"app.log", "other.log"}
    assert len({(r.segment, r.offset, r.value) for r in rows}) == len(rows)


def test_a_file_replaced_by_a_longer_one_of_the_same_beginning(followed):
    header = "# " + "header " * 60
    followed.append("app.log", f"{header}\nold 1\nold 2\n")
    followed.run()
    followed.path("app.log").unlink()
    followed.append("app.log", f"{header}\nnew 1\nnew 2\nnew 3\n")
    followed.run()
    assert followed.values() == Counter([header, header, "old 1", "old 2", "new 1", "new 2", "new 3"])


def test_ranges_share_the_lines_of_a_file(spark, tmp_path):
    followed = Followed(spark, tmp_path, split_bytes=64)
    lines = lines_of("line", 300) + ["", "y" * 500, "", "\r", "end"]
    followed.append("a.log", "\n".join(lines) + "\n")
    followed.run()
    assert followed.values() == Counter(x.removesuffix("\r") for x in lines)
    text = followed.path("a.log").read_bytes()
    assert all(text[r.offset:].decode().startswith(r.value) for r in followed.rows())


def test_planning_finds_renamed_bytes_and_fails_where_they_are_gone(tmp_path):
    path = tmp_path / "a.log"
    path.write_text("one\ntwo\nthr")
    reader = follow.FollowReader({"path": str(tmp_path)})
    end = reader.latestOffset()
    assert [v["at"] for v in end["files"].values()] == [8]
    os.rename(path, tmp_path / "a.log.1")
    (part,) = reader.partitions(reader.initialOffset(), end)
    assert part.path.endswith("a.log.1") and [v for b in reader.read(part) for v in b.column("value").to_pylist()] == ["one", "two"]
    (tmp_path / "a.log.1").write_text("o")
    with pytest.raises(ValueError, match="gone"):
        reader.partitions(reader.initialOffset(), end)


def test_unchanged_files_are_not_opened(tmp_path, monkeypatch):
    (tmp_path / "a.log").write_text("one\n")
    reader = follow.FollowReader({"path": str(tmp_path)})
    first = reader.latestOffset()
    monkeypatch.setattr(follow, "_bytes", None)
    monkeypatch.setattr(follow, "_last_break", None)
    assert reader.latestOffset() == first


def test_an_empty_or_missing_folder(spark, tmp_path):
    reader = follow.FollowReader({"path": str(tmp_path / "none")})
    assert reader.latestOffset() == {"files": {}} == reader.initialOffset()
