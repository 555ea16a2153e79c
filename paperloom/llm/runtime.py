"""What the operators need from the session: the package on executors, scratch tables."""

import os
import tempfile
import uuid
import zipfile

import paperloom


def ship(spark):
    """Send this package to the executors once, for clusters where it is not installed."""
    context = spark.sparkContext
    if getattr(context, "_paperloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(paperloom.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="paperloom-"), f"paperloom-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("paperloom", os.path.relpath(path, root)))
    context.addPyFile(archive)
    context._paperloom_shipped = True


def scratch_folder(spark):
    """A new folder under the shared checkpoint folder of the cluster.

    The session's `spark.checkpoint.dir` decides. Only in local mode, where all tasks
    share one machine, a folder of our own stands in when nothing is set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        chosen = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = chosen.get() if chosen.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="paperloom-scratch-")
    return f"{base.rstrip('/')}/paperloom-{uuid.uuid4().hex}"


def written(frame):
    """The frame as a written table: later steps reread it, also after losing executors."""
    spark = frame.sparkSession
    path = scratch_folder(spark)
    frame.write.parquet(path, compression="zstd")
    return spark.read.schema(frame.schema).parquet(path)


def free_names(frame, *names):
    """Column names like these that no column of the frame has, in any case."""
    taken, found = {c.lower() for c in frame.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found
