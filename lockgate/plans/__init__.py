"""Stages and runs: operators put together with sources and sinks."""
