"""Loads of several datasets side by side: one that fails does not stop the others."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from tidemark.sources.stores import LoadResult


class LoadFailed(RuntimeError):
    def __init__(self, results: list[LoadResult]):
        self.results = results
        failed = [f"{r.dataset}: {r.error}" for r in results if r.status == "FAILED"]
        super().__init__("; ".join(failed))


def run_isolated(loads: Mapping[str, Callable[[], LoadResult]]) -> list[LoadResult]:
    """One result per dataset; an error becomes a FAILED result."""
    results = []
    for dataset, load in loads.items():
        try:
            results.append(load())
        except Exception as error:  # noqa: BLE001 - reported, not swallowed
            results.append(LoadResult(dataset, "FAILED", error=str(error).split("\n")[0]))
    return results


def raise_failures(results: list[LoadResult]) -> list[LoadResult]:
    if any(r.status == "FAILED" for r in results):
        raise LoadFailed(results)
    return results
