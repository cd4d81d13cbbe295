"""Small dimension tables from YAML on the driver: tasks, tools, personas, rubrics, patterns, manifests."""

from __future__ import annotations

import json
import os
import re
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession

from corpusloom.schema import DATED_ID

_SLOT = re.compile(r"\{(\w+)\}")


def check_task(t: dict) -> dict:
    """A task template: id under its family, every placeholder with a parameter, zipped lists of equal length."""
    params = t.get("params") or {}
    missing = set(_SLOT.findall(t["prompt"])) - set(params) - {"persona"}
    if missing:
        raise ValueError(f"{t['id']}: placeholders without parameters: {sorted(missing)}")
    if not t["id"].startswith(f"{t['family']}."):
        raise ValueError(f"{t['id']}: an id begins with its family")
    if t.get("param_mode") == "zip" and len({len(v) for v in params.values()}) > 1:
        raise ValueError(f"{t['id']}: zipped lists of unequal length")
    return t


def load_tasks(root: str | Path) -> list[dict]:
    """Task templates in path order; files named TEMPLATE are skipped, repeated ids are an error."""
    tasks = [check_task(yaml.safe_load(p.read_text())) for p in sorted(Path(root).rglob("*.task.yaml")) if not p.name.startswith("TEMPLATE")]
    ids = [t["id"] for t in tasks]
    if len(ids) != len(set(ids)):
        raise ValueError(f"repeated ids: {sorted({i for i in ids if ids.count(i) > 1})}")
    return tasks


def tasks_table(spark: SparkSession, tasks: list[dict]) -> DataFrame:
    """Templates with their parameter lists as sorted arrays."""
    rows = [
        (i, t["id"], t["family"], bool(t.get("holdout")), t.get("param_mode", "product"), [(k, [str(v) for v in t["params"][k]]) for k in sorted(t.get("params") or {})], t["prompt"], int(t.get("n_rollouts", 4)), t["verifier"])
        for i, t in enumerate(tasks)
    ]
    ddl = "pos int, template_id string, family string, holdout boolean, mode string, params array<struct<name string, options array<string>>>, prompt string, n_rollouts int, verifier string"
    return spark.createDataFrame(rows, ddl)


def toolsets(root: str | Path) -> dict[str, str]:
    """Family to the JSON of its tools, keys as authored."""
    return {p.stem: json.dumps(yaml.safe_load(p.read_text()), ensure_ascii=False) for p in sorted(Path(root).glob("*.yaml"))}


def allowed_tools(root: str | Path) -> dict[str, set[str]]:
    """Family to the names of its functions."""
    return {k: {(t.get("function") or t)["name"] for t in json.loads(v)} for k, v in toolsets(root).items()}


def personas(root: str | Path) -> dict[str, dict]:
    """Personas by file stem."""
    return {p.stem: yaml.safe_load(p.read_text()) for p in sorted(Path(root).glob("*.yaml"))}


def personas_of_kind(all_personas: dict[str, dict], kind: str = "rp") -> list[str]:
    """Ids of a kind."""
    return sorted(k for k, v in all_personas.items() if v.get("kind", "rp") == kind)


def scrub_patterns(*paths: str | Path) -> list[tuple[str, str, str]]:
    """``label, pattern, action`` of pattern files; the action defaults to drop."""
    return [(e["label"], e["pattern"], e.get("action", "drop")) for p in paths for e in yaml.safe_load(Path(p).read_text()) or []]


def lane_policies(path: str | Path) -> dict[str, list[str]]:
    """Exempt labels by lane; a missing file exempts nothing."""
    p = Path(path)
    return {k: list(v.get("exempt_labels", [])) for k, v in (yaml.safe_load(p.read_text()) or {}).items()} if p.exists() else {}


def rubric(spark: SparkSession, path: str | Path) -> tuple[DataFrame, float]:
    """``axis, weight, minimum`` and the threshold of a rubric file."""
    r = yaml.safe_load(Path(path).read_text())
    return spark.createDataFrame([(k, float(a.get("weight", 1.0)), a.get("min")) for k, a in r["axes"].items()], "axis string, weight double, minimum double"), float(r["threshold"])


def pseudonym_rules(path: str | Path | None) -> tuple[list[str], list[str]]:
    """Name patterns and preserved names; a missing file has none."""
    raw = (yaml.safe_load(Path(path).read_text()) or {}) if path and Path(path).exists() else {}
    return list(raw.get("name_patterns", [])), list(raw.get("preserve", []))


def inline_seeds(seeds: list[dict], persona: str) -> list[dict]:
    """Seeds with the persona's name filled in."""
    return [s | {k: s[k].replace("{persona}", persona) for k in ("scenario", "user_goal") if k in s} for s in seeds]


def read_manifest(path: str | Path) -> dict:
    """A run manifest; model ids must be pinned."""
    m = yaml.safe_load(Path(path).read_text())
    for t in m.get("teachers", []) or []:
        if not re.search(DATED_ID, t["id"]) or "latest" in t["id"] or t["id"].endswith(":free"):
            raise ValueError(f"unpinned model id {t['id']}")
    return m


def write_manifest(manifest: dict, path: str | Path) -> None:
    """Written beside and renamed, so that a reader never sees half of it."""
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    tmp = p.with_suffix(".tmp")
    tmp.write_text(yaml.safe_dump(manifest, sort_keys=False, allow_unicode=True))
    tmp.replace(p)


def book_entry(work_id: str, path: str, author: str, title: str) -> str:
    """A book as appendable YAML."""
    q = lambda s: '"' + s.replace("\\", "\\\\").replace('"', '\\"') + '"'
    return f"- work_id: {work_id}\n  path: {q(path)}\n  author: {q(author)}\n  title: {q(title)}\n"


def data_dir(env: str = "CORPUSLOOM_DATA", repo: str | Path = ".") -> Path:
    """The data root; never inside the repository."""
    root = Path(os.environ.get(env, "~/corpusloom-data")).expanduser().resolve()
    if root == Path(repo).resolve() or Path(repo).resolve() in root.parents:
        raise ValueError(f"{root} lies inside the repository")
    return root


def narrowed_lanes(configured: list[str], wanted: list[str] | None) -> list[str]:
    """The wanted lanes in configured order; an unknown one is an error."""
    if wanted is None:
        return configured
    if set(wanted) - set(configured):
        raise ValueError(f"lanes not configured: {sorted(set(wanted) - set(configured))}")
    return [x for x in configured if x in wanted]


def same_prompts(recorded: str, now: str) -> None:
    """Refuses a run whose frozen inputs changed."""
    if recorded and recorded != now:
        raise ValueError("frozen inputs changed since the run was recorded")


def dataset_card(title: str, counts: dict[str, int], rates: list[dict], drops: list[dict]) -> str:
    """Markdown card with configs, counts, rates by lane and shares of drop reasons."""
    head = ["---", "configs:", *[f"- config_name: {k}\n  data_files: {k}/*" for k in counts], "---", f"# {title}", "", "| artifact | rows |", "| --- | ---: |", *[f"| {k} | {v} |" for k, v in counts.items()]]
    lanes = ["", "| lane | verify | judge |", "| --- | ---: | ---: |", *[f"| {r['lane']} | {r['verify_rate']:.4f} | {r['judge_rate']:.4f} |" for r in rates]] if rates else []
    total = sum(d["n"] for d in drops)
    reasons = ["", "| reason | share |", "| --- | ---: |", *[f"| {d['drop_reason']} | {d['n'] / total:.4f} |" for d in drops]] if drops else []
    return "\n".join([*head, *lanes, *reasons, ""])


def external_card(title: str, input_rows: int, drops: dict[str, int]) -> str:
    """Markdown card of a third-party corpus: what was dropped, with the share of all rows read."""
    kept = input_rows - sum(drops.values())
    lines = [f"| {reason} | {n} | {n / input_rows:.4f} |" for reason, n in sorted(drops.items(), key=lambda x: (-x[1], x[0]))] if input_rows else []
    return "\n".join([f"# {title}", "", f"{kept} of {input_rows} rows kept.", "", "| reason | rows | share |", "| --- | ---: | ---: |", *lines, ""])


def ship_plan(exempt_lanes: set[str], lanes: set[str], artifacts: dict[str, int]) -> list[str]:
    """Reasons not to publish: exempt lanes, missing or empty artifacts."""
    why = [f"lane {x} is exempt from publishing" for x in sorted(exempt_lanes & lanes)]
    return why + [f"{k} is missing or empty" for k, n in artifacts.items() if not n] + ([] if artifacts else ["nothing was rendered"])
