"""Ordered steps in one process: policies, metrics, run log, report."""

from __future__ import annotations

import datetime as dt
import decimal
import importlib
import json
import threading
import time
import traceback
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark import InheritableThread
from pyspark.sql import SparkSession

from .. import schemas
from ..operators.quality import CheckResult
from ..storage import Database, Fence


def json_default(value: Any) -> Any:
    if isinstance(value, dt.date | dt.datetime):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, CheckResult):
        return value.to_dict()
    return value.item() if hasattr(value, "item") else str(value)


@dataclass
class StepResult:
    layer: str
    step: str
    status: str = "ok"
    metrics: dict[str, Any] = field(default_factory=dict)
    checks: list[CheckResult] = field(default_factory=list)
    elapsed_s: float = 0.0
    error: str | None = None

    @property
    def success(self) -> bool:
        return self.status in ("ok", "skipped", "dry_run") and not any(not c.ok and c.severity == "error" for c in self.checks)

    def to_json(self) -> str:
        return json.dumps({"layer": self.layer, "step": self.step, "status": self.status, "success": self.success, "metrics": self.metrics, "checks": self.checks, "elapsed_s": round(self.elapsed_s, 3), "error": self.error}, default=json_default, ensure_ascii=False)


@dataclass
class Step:
    layer: str
    name: str
    run: Callable[[Any], StepResult | dict | None]
    enabled: bool = True
    monthly: bool = False
    alias: str | None = None
    timeout_s: float | None = None


class StepTimeout(RuntimeError):
    """A step ran longer than it may; its Spark jobs are cancelled."""


def with_timeout(spark: SparkSession | None, seconds: float | None, work: Callable[[], Any], name: str = "step") -> Any:
    """work() in a thread whose Spark jobs carry a tag: after `seconds` the jobs are cancelled and StepTimeout is raised, so
    that a step cannot hang for ever. Python code that starts no job goes on in its (daemon) thread, but its result is lost, and
    a fence keeps it from publishing tables: what a step publishes is there before its failure is told, or never."""
    if not seconds:
        return work()
    tag, box, fence = f"{name}-{uuid.uuid4().hex}", {}, Fence()

    def body() -> None:
        fence.hold()
        try:
            if spark is not None:
                spark.addTag(tag)
            box["value"] = work()
        except BaseException as e:  # noqa: BLE001  handed to the caller
            box["error"] = e

    thread = InheritableThread(target=body, daemon=True) if spark is not None else threading.Thread(target=body, daemon=True)
    thread.start()
    thread.join(seconds)
    if thread.is_alive():
        fence.close()
        if spark is not None:
            spark.interruptTag(tag)
        raise StepTimeout(f"{name} took more than {seconds:g} s")
    if "error" in box:
        raise box["error"]
    return box.get("value")


def load_step(layer: str, target: str, **settings: Any) -> Step:
    """A step from "module:function", imported when it runs."""

    def run(context: Any) -> Any:
        module, _, name = target.partition(":")
        return getattr(importlib.import_module(module), name or "main")(context)

    return Step(layer, target, run, **settings)


def select_steps(steps: Sequence[Step], only: str | None = None, today: dt.date | None = None) -> list[Step]:
    """Enabled steps in order; `only` is a comma list of names or aliases; monthly ones run on the first of a month."""
    wanted = {x.strip() for x in only.split(",") if x.strip()} if only else None
    out = [s for s in steps if (wanted is None and s.enabled and (not s.monthly or (today or dt.date.today()).day == 1)) or (wanted is not None and {s.name, s.alias} & wanted)]
    if wanted and (unknown := wanted - {n for s in steps for n in (s.name, s.alias)}):
        raise ValueError(f"unknown steps: {', '.join(sorted(unknown))}")
    return out


def run_steps(context: Any, steps: Sequence[Step], fail_fast: bool = True, emit: Callable[[str], None] | None = None, spark: SparkSession | None = None, dry_run: bool = False) -> list[StepResult]:
    """Runs steps one after the other, each within its timeout. With fail_fast the steps after a failure are recorded as
    skipped. dry_run: the context (a Database, or anything with a `dry_run`) writes nothing while the steps run, and what
    they would write is in their metrics under "planned"."""
    if dry_run:
        context.dry_run = True
    results: list[StepResult] = []
    failed = False
    for step in steps:
        if failed and fail_fast:
            results.append(StepResult(step.layer, step.name, "skipped", error="an earlier step failed"))
            continue
        began = time.monotonic()
        try:
            made = with_timeout(spark, step.timeout_s, lambda s=step: s.run(context), step.name)
            result = made if isinstance(made, StepResult) else StepResult(step.layer, step.name, metrics=made or {})
        except Exception as e:  # noqa: BLE001  a step's failure is a result
            result = StepResult(step.layer, step.name, "error", error=f"{type(e).__name__}: {e}", metrics={"trace": traceback.format_exc(limit=3)})
        result.elapsed_s = time.monotonic() - began
        if dry_run and result.status == "ok":
            result.status, result.metrics = "dry_run", result.metrics | {"planned": list(getattr(context, "planned", ()))}
        failed |= not result.success
        results.append(result)
        if emit:
            emit(result.to_json())
    return results


def roll_up(results: Sequence[StepResult], how: dict[str, str]) -> dict[str, Any]:
    """Metrics across steps: max, last or sum per name."""
    out: dict[str, Any] = {}
    for name, rule in how.items():
        values = [r.metrics[name] for r in results if isinstance(r.metrics.get(name), int | float)]
        if values:
            out[name] = {"max": max, "last": lambda v: v[-1], "sum": sum}[rule](values)
    return out


def find_metric(content: Any, names: Sequence[str]) -> float | None:
    """The first number under one of the names, at any depth."""
    if isinstance(content, dict):
        for n in names:
            if isinstance(content.get(n), int | float) and not isinstance(content[n], bool):
                return content[n]
        content = list(content.values())
    if isinstance(content, list):
        for v in content:
            if (got := find_metric(v, names)) is not None:
                return got
    return None


def last_json(text: str) -> dict | None:
    """The whole text as JSON, else its last line that is an object."""
    for part in (text, *reversed(text.splitlines())):
        try:
            if isinstance(got := json.loads(part), dict):
                return got
        except ValueError:
            continue
    return None


def log_run(spark: SparkSession, db: Database, results: Sequence[StepResult], table: str = "ops_daily_job", run_id: str | None = None) -> None:
    """Appends one row per step to the run log."""
    run_id, now = run_id or uuid.uuid4().hex, dt.datetime.now()
    rows = [(run_id, now.date(), r.layer, r.metrics.get("source"), r.step, r.success, r.status, r.elapsed_s, r.metrics.get("rows_in"), r.metrics.get("rows_out"), r.error, r.to_json(), now) for r in results]
    new = spark.createDataFrame(rows, schemas.RUN_LOG)
    db.append(table, new)


def report(results: Sequence[StepResult]) -> str:
    lines = [f"{r.layer:<10} {r.step:<24} {'ok' if r.success else 'FAILED':<7} {r.elapsed_s:8.1f} s  {r.error or ''}".rstrip() for r in results]
    bad = sum(not r.success for r in results)
    return "\n".join([*lines, f"{len(results)} steps, {bad} failed, {sum(r.elapsed_s for r in results):.1f} s"])


def retry(times: int, pause: float, work: Callable[[], Any]) -> Any:
    for n in range(times):
        try:
            return work()
        except Exception:  # noqa: BLE001
            if n + 1 == times:
                raise
            time.sleep(pause)
    return None


def failures_stop(outcomes: Iterable[bool], most: int = 8) -> int:
    """How many outcomes may be used: all, or those before `most` failures in a row, after which a batch service is given up."""
    run = used = 0
    for ok in outcomes:
        used += 1
        run = 0 if ok else run + 1
        if run >= most:
            return used
    return used
