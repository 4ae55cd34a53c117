"""What the titles and skills that the queries make are to be labelled: written down by hand, for their SQL."""

from __future__ import annotations

ROLES = """
    (VALUES ('Clerk', 'Other', 'Mid', 'Full-time'),
            ('Contract Platform Engineer', 'DevOps / Platform', 'Mid', 'Contract'),
            ('Entry Data Science, part-time', 'Data Scientist', 'Junior', 'Part-time'),
            ('Junior Software Engineer', 'Software Engineer', 'Junior', 'Full-time'),
            ('Lead Analytics Developer', 'Data Analyst', 'Lead/Principal', 'Full-time'),
            ('ML Engineer, Internal Tools', 'ML Engineer', 'Intern', 'Internship'),
            ('Machine Learning Intern', 'ML Engineer', 'Intern', 'Internship'),
            ('Product Owner (part time)', 'Product', 'Mid', 'Part-time'),
            ('Senior Data Engineer', 'Data Engineer', 'Senior', 'Full-time'),
            ('Senior Lead DevOps', 'DevOps / Platform', 'Lead/Principal', 'Full-time'),
            ('Staff Software Engineer (contract)', 'Software Engineer', 'Lead/Principal', 'Contract')
    ) AS roles(role, role_family, seniority_level, employment_type)"""

SKILLS = """
    (VALUES ('aws', 'cloud'), ('excel', 'other'), ('go', 'language'), ('postgres', 'database'), ('python', 'language'),
            ('redis', 'database'), ('spark', 'framework'), ('sql', 'language')
    ) AS skills(skill, skill_category)"""
