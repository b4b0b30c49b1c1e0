"""What a partitioned lake holds, by the names of its files.

Spark never writes a file name twice and never changes a file, so the names below a folder
tell whether its content is the one that was seen before, without opening a file.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

from pyspark.sql import DataFrame
from urllib.parse import unquote

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def folder_tokens(lake: DataFrame, column: str) -> dict[str | None, str]:
    """A digest of the file names of each value of a partition column.

    The names are those of Spark's own listing of the lake, which the driver holds anyway.
    """
    mark, names = f"/{column}=", defaultdict(list)
    for path in lake.inputFiles():
        _, found, rest = path.rpartition(mark)
        if found:
            value = unquote(rest.partition("/")[0])
            names[None if value == NO_VALUE else value].append(path.rpartition("/")[2])
    return {value: hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest() for value, files in names.items()}
