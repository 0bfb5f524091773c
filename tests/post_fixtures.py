"""Generated posts: the bare and the enveloped generation and all the special cases."""

from __future__ import annotations

import bz2
import gzip
import io
import json
import tarfile
from pathlib import Path


def millis(text: str) -> str:
    from datetime import datetime, timezone

    return str(int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000) + 345)


def post(number: int, at: str = "2022-01-01 00:00:10", lang: str = "en", **fields) -> dict:
    base = {
        "id": number, "id_str": str(number), "timestamp_ms": millis(at), "lang": lang, "text": f"text {number}", "truncated": False,
        "user": {"id_str": f"u{number}", "screen_name": f"name{number}", "display_name": f"Name {number}"},
        "in_reply_to_status_id": None, "quoted_status_id": None, "geo": None, "coordinates": None, "place": None,
        "entities": {"hashtags": []},
    }
    base.update(fields)
    return base


SPECIAL = {
    1: post(1),
    2: post(2, truncated=True, extended_tweet={"full_text": "the full text"}),
    3: post(3, truncated=True),
    4: post(4, in_reply_to_status_id=7),
    5: post(5, quoted_status_id=7),
    6: post(6, retweeted_status={"id": 7}),
    7: post(7, referenced_tweets=[{"id": "7"}]),
    8: post(8, possibly_sensitive=True),
    9: post(9, possibly_sensitive=False),
    10: post(10, geo={}),
    11: post(11, place={"name": "x"}),
    12: post(12, entities={"hashtags": [{"text": "a"}, {"text": "A"}, {"text": "a"}], "media": [{"media_url_https": "m1"}]}),
    13: post(13, entities={"media": [{"media_url_https": "m1"}]}, extended_entities={"media": [{"media_url_https": "m2"}, {"media_url_https": "m3"}]}),
    14: post(14, extended_entities={"media": []}),
    15: post(15, entities={"media": None}),
    16: post(16, lang="fr"),
}

ENVELOPE = {
    "data": {
        "id": "17", "lang": "en", "text": "new generation", "created_at": "2023-01-01T00:00:00.000Z", "geo": {}, "possibly_sensitive": False,
        "author_id": "1", "entities": {"annotations": []},
    },
    "includes": {"users": [], "tweets": []},
}


def json_lines(posts: list[dict]) -> str:
    return "\n".join(json.dumps(p) for p in posts) + "\n"


def add_member(tar: tarfile.TarFile, name: str, data: bytes) -> None:
    info = tarfile.TarInfo(name)
    info.size = len(data)
    tar.addfile(info, io.BytesIO(data))


def write_tar(path: Path, members: list[tuple[str, bytes]]) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    with tarfile.open(path, "w") as tar:
        for name, data in members:
            add_member(tar, name, data)


def small_archive(root: Path) -> None:
    """Two days; damaged, empty and foreign members in the first."""
    def lines(*numbers: int) -> bytes:
        return json_lines([post(n) for n in numbers]).encode()

    whole = gzip.compress(lines(90, 91) * 200)
    write_tar(root / "stream-2022-01" / "stream-20220101.tar", [
        ("20220101/20220101000200.json.gz", gzip.compress(lines(3) + b"\n" + b"{broken\n" + lines(4))),
        ("20220101/20220101000000.json.gz", gzip.compress(lines(1))),
        ("20220101/20220101000100.json.bz2", bz2.compress(lines(2))),
        ("20220101/20220101000300.json.gz", whole[: len(whole) // 2]),
        ("20220101/20220101000400.json.bz2", b"no bzip2 data"),
        ("20220101/20220101000500.json.gz", gzip.compress(b"")),
        ("20220101/readme.txt", b"not a member"),
        ("20220101/20220101000600.json.bz2", bz2.compress(lines(5))),
    ])
    write_tar(root / "stream-2022-01" / "stream-20220102.tar", [("20220102/20220102000000.json.gz", gzip.compress(lines(6, 7)))])
    (root / "stream-2022-01" / "notes.txt").write_text("no archive")
