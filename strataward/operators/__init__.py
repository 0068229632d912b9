"""Relational operators over keyed, dated tables."""
