from . import clock, errors, holidays, names, scalars, segments

__all__ = ["clock", "errors", "holidays", "names", "scalars", "segments"]
