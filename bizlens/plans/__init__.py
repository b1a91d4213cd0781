"""Composite reports (inventory section L): one function per report."""
