"""Python workers that give back what a task has used.

Spark keeps its Python workers for later tasks. What the allocators hold for them after a task, in
several workers of every executor, would otherwise add up over the stages of a job.
"""

import ctypes
import gc

import pyarrow as pa


def give_back():
    """Free what nothing refers to any more and return it to the system, where it allows that."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run):
    """``run``, a function of a task's batches, that gives memory back when the task has ended."""
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied
