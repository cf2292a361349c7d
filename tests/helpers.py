"""Small landed inputs for the tests."""

import io
import json
import os
import zipfile
from contextlib import contextmanager, redirect_stdout

from pyspark.sql import functions as F

from tributary.sources.archive import archive_paths, read_blocks, records, unpack


def put_zip(path, entries):
    """A zip file of ``{entry name: text or bytes}``."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, body in entries.items():
            archive.writestr(name, body)
    return str(path)


def put_extract(path, body, header="ignored,header"):
    return put_zip(path, {"extract.csv": f"{header}\n{body}"})


def put_pages(folder, pages, items="Objects", names=None, addressed=True):
    """Listing pages of ``[(plugin, link), ...]``, pretty-printed."""
    os.makedirs(folder, exist_ok=True)
    for number, page in enumerate(pages):
        last = number == len(pages) - 1
        body = {
            items: [{"PluginId": p, "DownloadLink": d, "Name": "extra"} for p, d in page],
            "NextPageUrl": None if last else f"page/{number + 1}",
        }
        if addressed and number:
            body["Url"] = f"page/{number}"
        with open(f"{folder}/{names[number] if names else f'page-{number:04d}'}.json", "w") as out:
            json.dump(body, out, indent=2)
    return str(folder)


def unpacked(spark, folder, seq=1):
    archives = archive_paths(spark, str(folder)).select(
        F.lit(seq).cast("bigint").alias("seq"),
        F.lit(1).cast("bigint").alias("part"),
        "path",
        "length",
    )
    return records(read_blocks(spark, unpack(archives)))


def plan(frame, mode="formatted"):
    """The physical plan as text."""
    out = io.StringIO()
    with redirect_stdout(out):
        frame.explain(mode)
    return out.getvalue()


@contextmanager
def settings(spark, **values):
    """Session settings for a while; ``__`` in a name stands for a dot."""
    named = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in named}
    for k, v in named.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
