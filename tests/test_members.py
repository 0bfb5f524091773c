"""The stored member index: headers once, members opened at their place."""

from __future__ import annotations

import bz2
import gzip
import tarfile

import pytest
from post_fixtures import json_lines, post, write_tar

from postquarry.sources import archive as AR
from postquarry.sources import members as MB


@pytest.fixture
def two(tmp_path):
    """Two archives; a name with a bar, a name that occurs in both, an empty member."""
    for day in ("01", "02"):
        members = [(f"d/202203{day}00000{i}.json.gz", gzip.compress(json_lines([post(10 * int(day) + i), post(100 * int(day) + i)]).encode())) for i in range(4)]
        members += [("d/odd|name.json.bz2", bz2.compress(json_lines([post(1000 + int(day))]).encode())), ("d/none.json.gz", gzip.compress(b"")), ("readme.txt", b"no")]
        write_tar(tmp_path / "stream-2022-03" / f"stream-202203{day}.tar", members)
    return str(tmp_path)


def rows_of(df):
    return sorted((r.dump, r.archive, r.member, r.line_no, r.value) for r in df.collect())


def test_index_names_every_member_and_its_place(spark, two):
    index = MB.index_members(spark, two).collect()
    assert len(index) == 12 and all(r.fault is None for r in index)
    for r in index:
        with tarfile.open(r.path) as tar:
            member = tar.getmember(r.member)
            assert (member.offset_data, member.size) == (r.offset, r.size)


@pytest.mark.parametrize("slice_bytes", [1, 1 << 20, 256 << 20])
def test_members_give_what_the_walk_gives(spark, two, slice_bytes):
    index = MB.index_members(spark, two)
    assert rows_of(MB.read_members(spark, two, index, slice_bytes=slice_bytes)) == rows_of(AR.read_archive(spark, two))


def test_conditions_on_the_index_prune(spark, two):
    index = MB.index_members(spark, two).where("archive = '20220302' and member like '%1.json.gz'")
    assert len(rows_of(MB.read_members(spark, two, index))) == 2


def test_lookup_opens_the_requested_members_alone(spark, two):
    index = MB.index_members(spark, two)
    asked = [("2022-03", "20220301", "d/odd|name.json.bz2", 0, "a"), ("2022-03", "20220302", "d/20220302000002.json.gz", 1, "b"),
             ("2022-03", "20220302", "d/20220302000002.json.gz", 1, "c"), ("2022-03", "20220302", "absent", 0, "d")]
    requests = spark.createDataFrame(asked, "dump string, archive string, member string, line_no long, tag string")
    found = MB.lookup_members(spark, two, index, requests)
    assert sorted((r.tag, r.value) for r in found.collect()) == sorted(
        (tag, value) for *place, line, tag in asked for *other, number, value in rows_of(AR.read_archive(spark, two)) if [*place, line] == [*other, number]
    )


def test_headers_are_walked_once(spark, two, tmp_path):
    stored = str(tmp_path / "index")
    MB.index_members(spark, two).write.parquet(stored)
    index = spark.read.parquet(stored)
    whole = rows_of(MB.read_members(spark, two, index))
    for path in {r.path for r in index.collect()}:
        with tarfile.open(path) as tar:
            places = [m.offset for m in tar.getmembers()]
        with open(path, "r+b") as raw:
            for place in places:  # overwrite every header
                raw.seek(place)
                raw.write(b"\xff" * 512)
    assert rows_of(MB.read_members(spark, two, index)) == whole
    request = spark.createDataFrame([("2022-03", "20220301", "d/20220301000003.json.gz", 1)], "dump string, archive string, member string, line_no long")
    assert MB.lookup_members(spark, two, index, request).count() == 1


def test_damage_is_a_row_a_fault_or_left_out(spark, two):
    index = MB.index_members(spark, two)
    target = index.where("archive = '20220301' and member like '%1.json.gz'").first()
    with open(target.path, "r+b") as raw:
        raw.seek(target.offset + target.size // 2)
        raw.write(b"\0" * 8)
    with open(index.where("archive = '20220302'").first().path, "r+b") as raw:
        raw.truncate(raw.seek(0, 2) - 10240)
    index = MB.index_members(spark, two)
    skipped = rows_of(MB.read_members(spark, two, index, bad_member="skip"))
    assert skipped == rows_of(AR.read_archive(spark, two, badMember="skip")) and len(skipped) < 18
    reported = MB.read_members(spark, two, index, bad_member="report").where("member_error is not null").collect()
    assert {r.member for r in reported} >= {target.member} and all(r.line_no == -1 for r in reported)
    with pytest.raises(Exception, match="gzip|decompress|CRC|invalid|byte"):
        MB.read_members(spark, two, index).collect()


def test_no_archive_at_all(spark, tmp_path):
    index = MB.index_members(spark, str(tmp_path))
    assert index.count() == 0 and MB.read_members(spark, str(tmp_path), index).count() == 0
