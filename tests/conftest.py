from __future__ import annotations

import io
import tarfile
from pathlib import Path

import pytest

from lakegauge.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def archive_bytes(members: dict[str, str]) -> bytes:
    """A ``tar.xz`` of the given member files."""
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w:xz") as tar:
        for name, text in members.items():
            data = text.encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    return buffer.getvalue()


def drop_archive(folder: str, name: str, text: str) -> Path:
    path = Path(folder) / f"{name}.tar.xz"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(archive_bytes({f"{name}.csv": text}))
    return path


FILLER = {"string": "x", "bigint": "1", "double": "1.5"}


def csv_text(schema, rows: list[dict[str, str]]) -> str:
    """CSV with the schema's columns; fields a row leaves out get a filler of their type."""
    lines = [",".join(schema.names)]
    for row in rows:
        lines.append(",".join(row.get(f.name, FILLER[f.dataType.simpleString()]) for f in schema.fields))
    return "\n".join(lines) + "\n"
