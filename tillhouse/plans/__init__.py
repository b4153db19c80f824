"""Staging models, marts, analytical questions and jobs."""
