"""Planners (which rows a run sends), progress state and the run lifecycle."""
