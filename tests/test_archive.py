from __future__ import annotations

import gzip
import tarfile

import pytest
from post_fixtures import json_lines, post, small_archive, write_tar
from pyspark.sql import functions as F

from postquarry.sources import archive as AR
from postquarry.sources.archive import lookup_lines


def read_archive(spark, root, **options):
    """The small archive holds damaged members."""
    return AR.read_archive(spark, root, **{"badMember": "skip", **options})


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    folder = tmp_path_factory.mktemp("archive")
    small_archive(folder)
    return str(folder)


def ids(df):
    return sorted(int(i) for (i,) in df.select(F.get_json_object("value", "$.id")).collect() if i)


def test_good_members_survive_damaged_ones(spark, root):
    df = read_archive(spark, root)
    assert ids(df) == [1, 2, 3, 4, 5, 6, 7]
    assert df.columns == ["dump", "archive", "member", "line_no", "value"]


def test_location_counts_physical_lines(spark, root):
    df = read_archive(spark, root).where("member LIKE '%000200.json.gz'").orderBy("line_no")
    got = [(r["dump"], r["archive"], r["line_no"], r["value"][:7]) for r in df.collect()]
    assert [g[2] for g in got] == [0, 2, 3]
    assert got[1] == ("2022-01", "20220101", 2, "{broken")


def test_slices_share_the_members(spark, root):
    whole, sliced = read_archive(spark, root), read_archive(spark, root, sliceBytes=512)
    assert sliced.rdd.getNumPartitions() > whole.rdd.getNumPartitions()
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, sliced.collect()))


@pytest.fixture
def five(tmp_path):
    """An archive of five members, with their headers."""
    path = tmp_path / "stream-2022-03" / "stream-20220301.tar"
    write_tar(path, [(f"d/2022030100000{i}.json.gz", gzip.compress(json_lines([post(i)]).encode())) for i in range(5)])
    with tarfile.open(path) as tar:
        return path, tar.getmembers()


def check_damage(spark, path, kept, reported):
    root = str(path.parent.parent)
    for size in (512, 256 << 20):
        assert ids(read_archive(spark, root, sliceBytes=size)) == kept
        report = read_archive(spark, root, sliceBytes=size, badMember="report")
        assert ids(report) == kept and report.where("member_error IS NOT NULL").count() == reported
    with pytest.raises(Exception, match="(?i)broken header|end"):
        AR.read_archive(spark, root).count()


def test_a_cut_archive_keeps_its_whole_members(spark, five):
    path, members = five
    path.write_bytes(path.read_bytes()[: members[-1].offset_data + members[-1].size // 2])
    check_damage(spark, path, [0, 1, 2, 3], 2)


def test_an_archive_cut_between_members_is_seen(spark, five):
    path, members = five
    path.write_bytes(path.read_bytes()[: members[3].offset])
    check_damage(spark, path, [0, 1, 2], 1)


@pytest.mark.parametrize("broken", [0, 2, 4])
def test_a_broken_header_hides_its_member_only(spark, five, broken):
    path, members = five
    data = bytearray(path.read_bytes())
    data[members[broken].offset : members[broken].offset + 512] = b"\xff" * 512
    path.write_bytes(data)
    check_damage(spark, path, [i for i in range(5) if i != broken], 1)


def test_damaged_members_are_reported_or_fail(spark, root):
    report = read_archive(spark, root, badMember="report")
    assert sorted(r["member"][-16:] for r in report.where("member_error IS NOT NULL").collect()) == ["01000300.json.gz", "1000400.json.bz2"]
    with pytest.raises(Exception, match="(?i)invalid|ended|bz|gz"):
        read_archive(spark, root, badMember="fail").count()
    with pytest.raises(Exception, match="badMember"):
        read_archive(spark, root, badMember="maybe").count()


def test_unreadable_archive_is_empty(spark, tmp_path):
    folder = tmp_path / "stream-2022-02"
    folder.mkdir()
    (folder / "stream-20220201.tar").write_bytes(b"x" * 2000)
    assert read_archive(spark, str(tmp_path)).count() == 0
    assert read_archive(spark, str(tmp_path), badMember="report").count() == 1


def test_location_filters_prune_partitions(spark, root):
    day = read_archive(spark, root).where("archive = '20220102'")
    assert read_archive(spark, root).where("archive = '20220103'").count() == 0
    assert ids(day) == [6, 7] and day.rdd.getNumPartitions() == 1
    one = read_archive(spark, root).where("member IN ('20220101/20220101000000.json.gz', '20220102/20220102000000.json.gz') AND line_no = 0")
    assert ids(one) == [1, 6]


@pytest.mark.parametrize("max_members", [100, 1])
def test_lookup_by_location(spark, root, max_members):
    asked = spark.createDataFrame([
        ("2022-01", "20220102", "20220102/20220102000000.json.gz", 1, 0),
        ("2022-01", "20220101", "20220101/20220101000200.json.gz", 3, 1),
        ("2022-01", "20220101", "20220101/20220101000200.json.gz", 77, 2),
    ], "dump STRING, archive STRING, member STRING, line_no BIGINT, req_pos INT")
    found = lookup_lines(spark, root, asked, max_members, badMember="skip")
    assert [(r["req_pos"], r["id"]) for r in found.select("req_pos", F.get_json_object("value", "$.id").alias("id")).orderBy("req_pos").collect()] == [(0, "7"), (1, "4")]


@pytest.mark.parametrize("prefix", ["file:", "file://"])
def test_uris_name_the_same_folder(spark, root, prefix):
    assert ids(read_archive(spark, prefix + root)) == [1, 2, 3, 4, 5, 6, 7]


def test_members_are_packed_and_unpacked_in_pieces():
    import bz2
    import gzip
    import io
    import tracemalloc

    import pandas as pd

    from postquarry.plans.derived import pack_lines
    from postquarry.sources.archive import unpack

    lines = pd.Series([f"{k:05d}" * 400 for k in range(10_000)])
    tracemalloc.start()
    packed = [pack_lines(lines, bzip2) for bzip2 in (False, True)]
    with unpack(io.BytesIO(packed[0]), "a.json.gz") as whole:
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 20 << 20
        text = whole.read()
    assert text == bz2.decompress(packed[1]) == gzip.decompress(packed[0]) == ("\n".join(lines) + "\n").encode()
    assert gzip.decompress(pack_lines(pd.Series([], dtype=str), False)) == b"\n"
