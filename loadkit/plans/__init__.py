"""The three jobs: planning template, designation split, forecast accuracy."""
