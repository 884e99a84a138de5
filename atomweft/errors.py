"""Errors with the exit codes of the command line."""


class PipelineError(RuntimeError):
    exit_code = 1


class ValidationError(PipelineError):
    exit_code = 3


class MissingDependencyError(PipelineError):
    exit_code = 4


class BackendRuntimeError(PipelineError):
    exit_code = 5


class ConfigError(ValueError):
    exit_code = 2


class InputError(ValueError):
    """An input that cannot be found, read or selected from."""

    exit_code = 3
