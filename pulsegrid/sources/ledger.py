"""A small log of numbered entries in a folder: what writers of one store or topic agree on.

An entry is a JSON file whose name is its number. It is written aside and renamed to the next free number, which fails
if another writer was faster; then the entry is made again over what that one has written. Renaming without
overwriting is atomic on HDFS, and so is linking on mounted file systems; stores without either need one writer at a time.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

DIGITS = 12


class Folder:
    """Files of a folder, by Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.path = self.jvm.org.apache.hadoop.fs.Path(path)
        self.files = self.path.getFileSystem(self.conf)

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.path, name)

    def names(self, below: str | None = None) -> list[str]:
        place = self.path if below is None else self.at(below)
        return sorted(s.getPath().getName() for s in self.files.listStatus(place)) if self.files.exists(place) else []

    def exists(self, name: str) -> bool:
        return self.files.exists(self.at(name))

    def modified(self, name: str) -> int:
        """Milliseconds since 1970."""
        return self.files.getFileStatus(self.at(name)).getModificationTime()

    def read(self, name: str) -> str:
        stream = self.files.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a file as a whole; False if there is one of this name."""
        if self.files.getUri().getScheme() == "file":
            return create_locally(self.path.toUri().getPath(), name, text)
        aside = self.at(f".{uuid.uuid4().hex}.tmp")
        stream = self.files.create(aside, False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.files.getUri(), self.conf)
        options = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(aside, self.at(name), options)
        except (Py4JJavaError, PySparkException) as error:
            self.files.delete(aside, False)
            if "FileAlreadyExists" in str(error) or self.exists(name):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self.files.delete(self.at(name), True)


def create_locally(folder: str, name: str, text: str) -> bool:
    """As ``Folder.create``, in a folder that is mounted here: a link never replaces a file."""
    os.makedirs(folder, exist_ok=True)
    aside = os.path.join(folder, f".{uuid.uuid4().hex}.tmp")
    with open(aside, "x", encoding="utf-8") as file:
        file.write(text)
    try:
        os.link(aside, os.path.join(folder, name))
    except FileExistsError:
        return False
    finally:
        os.unlink(aside)
    return True


def numbers(folder: Folder) -> list[int]:
    return [int(n[:DIGITS]) for n in folder.names() if n.endswith(".json") and n[:DIGITS].isdigit()]


def entry(folder: Folder, number: int) -> dict:
    return json.loads(folder.read(f"{number:0{DIGITS}d}.json"))


def append(folder: Folder, make: Callable[[int], dict]) -> dict:
    """Add the entry that ``make`` gives for a number, and return it.

    ``make`` is called again with a greater number if another writer took this one.
    """
    while True:
        number = max(numbers(folder), default=0) + 1
        made = make(number)
        if folder.create(f"{number:0{DIGITS}d}.json", json.dumps(made)):
            return made
