"""Pipelines that chain operators: bronze to silver, silver to gold, gold to training set."""
