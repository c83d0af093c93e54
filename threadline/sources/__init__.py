"""Where data comes from and goes to: program files, declared tables, JSON."""
