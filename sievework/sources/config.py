"""Target and filter configurations in YAML, read on the driver."""

from __future__ import annotations

import hashlib
from pathlib import Path

import yaml


def load_yaml(path: str | Path) -> dict:
    """A YAML file as a dict; an empty file is an empty dict."""
    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}


def _merged(base: dict, over: dict) -> dict:
    out = dict(base)
    for key, value in over.items():
        out[key] = _merged(out[key], value) if isinstance(value, dict) and isinstance(out.get(key), dict) else value
    return out


def load_profile(path: str | Path, strict: bool = False, _seen: tuple = ()) -> dict:
    """A filter profile with ``extends`` and ``<section>_override`` applied; later values win.

    With ``strict`` the file is taken as it stands.
    """
    path = Path(path)
    own = load_yaml(path)
    if strict:
        return own
    if path.resolve() in _seen:
        raise ValueError(f"{path} extends itself")
    parent = own.pop("extends", None)
    out = _merged(load_profile(path.parent / parent, _seen=(*_seen, path.resolve())), own) if parent else own
    for key in [k for k in out if k.endswith("_override")]:
        name = key.removesuffix("_override")
        out[name] = _merged(out.get(name) or {}, out.pop(key) or {})
    return out


def config_hash(path: str | Path) -> str:
    """Ten hexadecimal digits of a file's content, the same whatever its comments and key order."""
    return hashlib.sha256(yaml.safe_dump(yaml.safe_load(Path(path).read_text(encoding="utf-8"))).encode()).hexdigest()[:10]


def config_hashes(folder: str | Path) -> dict[str, str]:
    """Hash to path of all ``*.yaml`` files below a folder; unreadable ones are skipped, of equal ones the later path counts."""
    out = {}
    for path in sorted(Path(folder).rglob("*.yaml")) if Path(folder).is_dir() else ():
        try:
            out[config_hash(path)] = str(path)
        except (OSError, yaml.YAMLError, UnicodeDecodeError):
            continue
    return out


def target_id(path: str | Path) -> str:
    """The configured id of a target, or the file's name."""
    return (load_yaml(path).get("target") or {}).get("id") or Path(path).stem
