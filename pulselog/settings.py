"""Job options, read once from a session configuration or any mapping."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """What a telemetry job can be told: names follow the property table."""

    extended: bool = False
    job: str = "no-job-name"
    push_gateway: str | None = None
    kafka_broker: str | None = None
    kafka_topic: str | None = None
    instance: str = "pulselog"
    #: Connections that push at the same time, and log files of one micro-batch.
    connections: int = 4
    max_files: int = 64
    #: Whether log files are read while they grow, or once they are sealed.
    live: bool = False

    @classmethod
    def read(cls, conf: Mapping[str, str] | Callable, prefix: str = "spark.pulselog") -> Settings:
        """Read ``<prefix>.<option>`` from a mapping or from ``spark.conf.get``."""
        lookup = conf.get if isinstance(conf, Mapping) else conf

        def option(name: str) -> str | None:
            return lookup(f"{prefix}.{name}", None)

        def number(name: str, default: int) -> int:
            text = option(name)
            if text is None:
                return default
            if not text.strip().isdigit() or int(text) < 1:
                raise ValueError(f"{prefix}.{name} must be a whole number from 1 on, not {text!r}")
            return int(text)

        def switch(name: str) -> bool:
            flag = option(name)
            if flag is not None and flag.strip().lower() not in ("true", "false"):
                raise ValueError(f"{prefix}.{name} must be true or false, not {flag!r}")
            return flag is not None and flag.strip().lower() == "true"

        return cls(
            extended=switch("extendedmode"),
            job=option("jobname") or cls.job,
            push_gateway=option("pushgateway"),
            kafka_broker=option("kafkaBroker"),
            kafka_topic=option("kafkaTopic"),
            instance=option("instance") or cls.instance,
            connections=number("connections", cls.connections),
            max_files=number("maxFilesPerTrigger", cls.max_files),
            live=switch("live"),
        )

    def require(self, name: str) -> str:
        """Value of an option that a sink cannot work without."""
        value = getattr(self, name)
        if not value:
            raise ValueError(f"option {name} is required for this sink")
        return value
