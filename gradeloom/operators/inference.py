"""Batch inference with a caller-supplied generate function."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class GenerationParams:
    """The documented generation defaults."""

    batch_size: int = 32
    max_new_tokens: int = 1024
    temperature: float = 0.0
    top_p: float = 1.0


# (prompts, parameters) -> (responses, input token counts, output token counts)
Generate = Callable[[Sequence[str], dict], tuple[Sequence[str], Sequence[int], Sequence[int]]]


def generate_responses(prompts: DataFrame, loader: Callable[[], Generate], params: GenerationParams = GenerationParams(),
                       prompt: str = "prompt", partitions: int | None = None, timed: bool = False) -> DataFrame:
    """The input rows with ``response``, ``input_tokens`` and ``output_tokens``, and when ``timed`` each row's share of its batch's seconds.

    ``loader`` runs once per task and returns the function that maps a list of prompts and the
    parameters to responses, input and output token counts; it is called with ``batch_size`` prompts, and fewer only at the end of
    a task. ``partitions`` deals the rows out to that many tasks, round robin: a small file is otherwise read by one. Of the
    Arrow batches only the prompt column becomes Python objects, all others pass through. A loader defined
    in a module of its own needs that module on the executors (``spark.addArtifacts`` or ``--py-files``).
    Generation is costly: write the result to a table before grading it.
    """
    added = [
        T.StructField("response", T.StringType()),
        T.StructField("input_tokens", T.IntegerType()),
        T.StructField("output_tokens", T.IntegerType()),
        *([T.StructField("elapsed_s", T.DoubleType())] if timed else []),
    ]
    schema = T.StructType([*prompts.schema.fields, *added])
    settings, size = asdict(params), params.batch_size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        generate = loader()

        def answered(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            texts = rows.column(prompt).to_pylist()
            results: tuple[list, list, list] = ([], [], [])
            seconds: list[float] = []
            for start in range(0, len(texts), size):
                mine = texts[start : start + size]
                begin = time.perf_counter()
                for result, part in zip(results, generate(mine, settings), strict=True):
                    result.extend(part)
                seconds += [(time.perf_counter() - begin) / len(mine)] * len(mine)
            types = (pa.string(), pa.int32(), pa.int32())
            arrays = [pa.array(result, type_) for result, type_ in zip(results, types)]
            arrays += [pa.array(seconds, pa.float64())] if timed else []
            yield from pa.Table.from_arrays([*rows.columns, *arrays], schema.names).combine_chunks().to_batches()

        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            full = rows.num_rows // size * size
            if full:
                yield from answered(rows.slice(0, full))
            rest = rows.slice(full)
        if rest is not None and rest.num_rows:
            yield from answered(rest)

    return (prompts.repartition(partitions) if partitions else prompts).mapInArrow(run, schema)
