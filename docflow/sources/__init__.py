"""Reading notifications and objects, writing outputs."""
