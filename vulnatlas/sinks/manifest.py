"""Published states: numbered files, each of which names everything that is live at one time.

Data goes to folders of its own first; then one small file makes it live, all at once. A reader takes the newest
whole file and so never sees half of a change. A file is created only if its number is free: of two writers that
started from the same state one fails, and a file that its writer left unfinished is passed over.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from vulnatlas.session import hadoop_path

STATES = "_states"


class StateMoved(RuntimeError):
    """Another writer has published a state since this one was read; read it and try again."""


def _files(spark: SparkSession, root: str) -> dict[int, str]:
    folder, fs = hadoop_path(spark, f"{root.rstrip('/')}/{STATES}")
    if not fs.exists(folder):
        return {}
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return {int(name.removesuffix(".json")): f"{root.rstrip('/')}/{STATES}/{name}" for name in names if name.endswith(".json")}


def _content(spark: SparkSession, path: str) -> dict | None:
    """The state in a file; None if it is not whole."""
    target, fs = hadoop_path(spark, path)
    stream = fs.open(target)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except json.JSONDecodeError:
        return None


def read_state(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the newest whole state; ``(0, {})`` where none is published."""
    files = _files(spark, root)
    for number in sorted(files, reverse=True):
        state = _content(spark, files[number])
        if state is not None:
            return number, state
    return 0, {}


def publish_state(spark: SparkSession, root: str, base: int, state: dict) -> int:
    """Make ``state``, which was made from state number ``base``, the newest one; its number."""
    files = _files(spark, root)
    newest = max((n for n in files if n <= base or _content(spark, files[n]) is not None), default=0)
    if newest != base:
        raise StateMoved(f"state {newest} of {root} is newer than {base}")
    number = max(files, default=0) + 1
    target, fs = hadoop_path(spark, f"{root.rstrip('/')}/{STATES}/{number:012d}.json")
    stream = fs.create(target, False)
    try:
        stream.write(bytearray(json.dumps(state), "utf-8"))
    finally:
        stream.close()
    return number


def remove_unused(spark: SparkSession, folder: str, live: set[str]) -> list[str]:
    """Remove what ``folder`` holds beside ``live``; the names. For a time when nobody reads an older state or writes."""
    base, fs = hadoop_path(spark, folder)
    if not fs.exists(base):
        return []
    gone = [s.getPath() for s in fs.listStatus(base) if s.getPath().getName() not in live]
    for path in gone:
        fs.delete(path, True)
    return sorted(path.getName() for path in gone)


def remove_older_states(spark: SparkSession, root: str) -> None:
    newest, _ = read_state(spark, root)
    for number, file in _files(spark, root).items():
        if number < newest:
            target, fs = hadoop_path(spark, file)
            fs.delete(target, False)
