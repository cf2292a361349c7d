import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest

from tributary.storage import create_json, file_names, folder_bytes, read_json, resolve, work_folder


class Session:
    """As much of a session as the work folder needs."""

    def __init__(self, **settings):
        self.conf = {k.replace("__", "."): v for k, v in settings.items()}


def test_work_folders_lie_in_the_shared_folder():
    session = Session(spark__checkpoint__dir="hdfs://names/shared/", spark__master="yarn")
    one, other = work_folder(session, "records"), work_folder(session, "records")
    assert one.startswith("hdfs://names/shared/records-") and one != other


def test_only_a_local_session_may_do_without_the_setting():
    assert work_folder(Session(spark__master="local[2]"), "x").startswith(tempfile.gettempdir())
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(Session(spark__master="yarn"), "x")


def test_small_files(tmp_path):
    folder = f"file:{tmp_path}/a/b"
    assert file_names(folder) == []
    create_json(folder, "2.json", {"x": 1})
    create_json(folder, "1.json", {})
    assert file_names(f"{tmp_path}/a/b") == ["1.json", "2.json"]
    assert read_json(f"{tmp_path}/a/b/2.json") == {"x": 1}
    assert folder_bytes(f"{tmp_path}/a") == len('{"x": 1}') + len("{}")
    with pytest.raises(FileExistsError):
        create_json(folder, "1.json", {})
    assert [n for n in (tmp_path / "a/b").iterdir() if n.name.startswith(".")] == []


def test_exactly_one_of_two_writers_succeeds(tmp_path):
    def attempt(name, writer):
        try:
            create_json(str(tmp_path), name, {"writer": writer})
            return writer
        except FileExistsError:
            return None

    with ThreadPoolExecutor(2) as pool:
        for race in range(300):
            both = [pool.submit(attempt, f"{race}.json", writer) for writer in (1, 2)]
            won = [w for w in (f.result() for f in both) if w]
            assert len(won) == 1 and read_json(f"{tmp_path}/{race}.json") == {"writer": won[0]}


def test_spark_names_of_a_store_are_known(monkeypatch):
    seen = []
    class Systems:
        class FileSystem:
            from_uri = staticmethod(lambda uri: seen.append(uri) or (None, uri))

    monkeypatch.setattr("tributary.storage.fs", Systems)
    for path in ("s3a://bucket/key", "s3n://bucket/key", "s3://bucket/key", "hdfs://names/key"):
        resolve(path)
    assert seen == ["s3://bucket/key"] * 3 + ["hdfs://names/key"]
