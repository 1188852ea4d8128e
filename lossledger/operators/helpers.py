"""Processes that help a task with rows too many for one core.

A task forks them before it has rows, deals its rows out and asks all of them the same thing. They
live as long as the task: each ends when its pipe to the task is closed, also if the task is killed.
"""

from __future__ import annotations

import mmap
import multiprocessing
import warnings
from collections.abc import Callable
from multiprocessing.connection import Connection

import numpy as np


class Helpers:
    """``n`` processes, each with an object that ``make`` gives. ``tell`` calls a method of it,
    ``add_up`` adds up to ``size`` numbers that a method of all of them puts into shared memory."""

    def __init__(self, n: int, make: Callable[[], object], size: int):
        context = multiprocessing.get_context("fork")
        self.pipes: list[Connection] = []
        self.processes = []
        self.numbers = np.frombuffer(mmap.mmap(-1, n * size * 8)).reshape(n, size)
        for own in self.numbers:
            here, there = context.Pipe()
            self.pipes.append(here)
            process = context.Process(target=_serve, args=(there, list(self.pipes), make, own),
                                      daemon=True)
            with warnings.catch_warnings():
                # The threads that the warning is about belong to Arrow, which helpers do not use.
                warnings.simplefilter("ignore", DeprecationWarning)
                process.start()
            there.close()
            self.processes.append(process)

    def tell(self, helper: int, method: str, *args) -> None:
        self.pipes[helper].send((method, args, 0))

    def tell_all(self, method: str, *args) -> None:
        for helper in range(len(self.pipes)):
            self.tell(helper, method, *args)

    def add_up(self, size: int, method: str, *args) -> np.ndarray:
        for pipe in self.pipes:
            pipe.send((method, args, size))
        for pipe in self.pipes:
            pipe.recv_bytes()
        return self.numbers[:, :size].sum(axis=0)

    def close(self) -> None:
        for pipe in self.pipes:
            pipe.close()
        for process in self.processes:
            process.join()


def _serve(pipe: Connection, others: list[Connection], make: Callable[[], object],
           numbers: np.ndarray) -> None:
    # Ends of pipes that this process has from its parent would keep them open without it.
    for other in others:
        other.close()
    own = make()
    while True:
        try:
            method, args, size = pipe.recv()
        except EOFError:
            return
        if size:
            getattr(own, method)(numbers[:size], *args)
            pipe.send_bytes(b".")
        else:
            getattr(own, method)(*args)


def shares(works: dict[int, float], most: dict[int, int], cores: int, each: int) -> dict[int, int]:
    """How many processes work on each of several things that share ``cores``: as many as its part
    of all work, at least one, no more than ``most`` says and ``each``, the cores of one machine."""
    whole = sum(works.values()) or 1.0
    return {k: max(1, min(each, most[k], round(cores * work / whole)))
            for k, work in works.items()}
