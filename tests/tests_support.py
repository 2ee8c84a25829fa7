"""Helpers of the streaming tests."""


def write_slices(folder, lines, files, prefix="a"):
    folder.mkdir(exist_ok=True)
    size = -(-len(lines) // files)
    for number in range(files):
        part = lines[number * size : (number + 1) * size]
        (folder / f"{prefix}{number}.json").write_text("".join(f"{line}\n" for line in part))


def drain(spark, stream, tmp_path):
    out = str(tmp_path / "drained")
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "drain-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def greedy(rows, short=0.5, long=5.0):
    """Kept numbers of (camera, time, violent, n) rows that are in time order."""
    last, kept = {}, set()
    for camera, at, violent, n in rows:
        gap = short if violent else long
        if camera not in last or (at - last[camera]).total_seconds() >= gap:
            last[camera] = at
            kept.add(n)
    return kept
