"""Layered settings: a nearer layer wins, and fills only what it names."""

from __future__ import annotations


def defaults(*layers: dict | None) -> dict:
    """The first layer, with keys that it lacks from the next ones. A key that is there with None stays None."""
    out: dict = {}
    for layer in layers:
        for key, value in (layer or {}).items():
            out.setdefault(key, value)
    return out


def endpoints(service: dict, base: dict) -> dict[str, dict]:
    """Named endpoints of a service, each over the service's `default` and that over the base's `default`."""
    return {name: defaults(own, service.get("default"), base.get("default")) for name, own in service.items() if name != "default"}


def urls(found: dict[str, dict], protocol: str = "https") -> dict[str, str]:
    """Endpoints with their settings as URLs: protocol, hostname, port if there is one, path. They can be polled as they are."""
    return {name: f"{conf.get('protocol', protocol)}://{conf['hostname']}{':' + str(conf['port']) if conf.get('port') else ''}{conf.get('path', '/')}" for name, conf in found.items()}
